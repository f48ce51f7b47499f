"""Chat formatting by schema fingerprinting, with DataFrame functions only.

A record's nested field paths are hashed. Of the declared layouts (``MAPPINGS``) the one with the most paths that the record has
all of is taken, if no further path of the record belongs to any layout: fields that hold conversation are never dropped
in silence, other fields don't matter. The hash of its paths is the record's layout fingerprint, and this
hash selects the mapping that names where turns, roles and texts lie, and so turns prompt, instruction and message
layouts into canonical turns ``array<struct<role, text>>``. In a list whose elements name their text differently, each
element is read by its own name. A template then writes the turns with a loss mask, and
``parse`` and ``masked_text`` read them back.

Template, one turn after another::

    ### <role>: <text></turn>

Escapes put a backslash inside a control string and before every backslash, so neither
``###`` nor ``</turn>`` occurs in an escaped text, and an end mark can be found by a plain
split. Unescaping drops each backslash and keeps the character behind it.

The loss mask lists, for each assistant turn, the turn's number and the code points [begin, end) of its line that the text takes.

- A null role, text or prompt field counts as empty; a list's paths are those of all its elements, and an empty list gives no turns. A
  record without a mapping, with two answers (``response`` and ``completion``), or with an element of two texts gets null turns from
  ``canonical_turns`` and no formatted text; ``unmapped`` lists its fingerprint.
- A null conv_id is a conversation of its own.
- Turns of rows are ordered by (turn, role, text), nulls first, so ties and repeated rows have
  one order; repeated rows stay. A conversation's rows meet in one row, as a conversation does in any format.
- An empty table gives an empty result; extra columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN = "struct<role:string,text:string>"

# Layouts (their field paths) and how each becomes turns. A turn is (role, field),
# or, for a list, (list field, role field, text field);
# a role field with = in front keeps its roles as they are.
MAPPINGS: dict[tuple[str, ...], list[tuple]] = {
    ("messages[].content", "messages[].role"): [("messages", "role", "content")],
    ("messages[].role", "messages[].text"): [("messages", "=role", "text")],
    ("messages[].content", "messages[].role", "messages[].text"): [("messages", "role", "content|text")],
    ("conversations[].from", "conversations[].value"): [("conversations", "from", "value")],
    ("prompt", "response"): [("user", "prompt"), ("assistant", "response")],
    ("completion", "prompt"): [("user", "prompt"), ("assistant", "completion")],
    ("instruction", "output"): [("user", "instruction"), ("assistant", "output")],
    ("input", "instruction", "output"): [("user", "instruction"), ("user", "input"), ("assistant", "output")],
    ("instruction", "output", "system"): [("system", "system"), ("user", "instruction"), ("assistant", "output")],
    ("input", "instruction", "output", "system"): [("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output")],
    ("completion", "prompt", "system"): [("system", "system"), ("user", "prompt"), ("assistant", "completion")],
    ("prompt", "response", "system"): [("system", "system"), ("user", "prompt"), ("assistant", "response")],
    ("messages[]",): [],
    ("conversations[]",): [],
}
# Names of roles in such layouts and the canonical role.
ROLES = {"human": "user", "user": "user", "prompter": "user", "gpt": "assistant", "assistant": "assistant", "bot": "assistant", "model": "assistant", "system": "system"}


def paths_of(kind: T.DataType, prefix: str = "") -> list[str]:
    """The nested field paths of a type, sorted; ``[]`` marks a list's elements."""
    if isinstance(kind, T.StructType):
        return sorted(p for f in kind.fields for p in paths_of(f.dataType, f"{prefix}.{f.name}" if prefix else f.name))
    if isinstance(kind, T.ArrayType):
        return paths_of(kind.elementType, prefix + "[]")
    return [prefix]


def fingerprint(paths) -> Column:
    """The hash of sorted field paths (a list of names, or a column with an array of them)."""
    listed = paths if isinstance(paths, Column) else F.array(*(F.lit(p) for p in sorted(paths)))
    return F.xxhash64(F.array_join(F.array_sort(listed), "\n"))


def _role(value: Column) -> Column:
    known = F.create_map(*(F.lit(x) for pair in ROLES.items() for x in pair))
    value = F.coalesce(value.cast("string"), F.lit(""))
    return F.coalesce(known[F.lower(F.trim(value))], value)


def _turns(frame: Column, layout: tuple[str, ...], mapping: list[tuple]) -> Column:
    if not mapping:
        return F.array().cast(f"array<{TURN}>")
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    if len(mapping[0]) == 3:
        items, role, content = mapping[0]
        named = lambda t: text(t[role[1:]]) if role[0] == "=" else _role(t[role])
        names = content.split("|")
        said = lambda t: F.coalesce(*(t[n] for n in names))
        turns = F.transform(frame[items], lambda t: F.struct(named(t).alias("role"), text(said(t)).alias("text")))
        if len(names) == 1:
            return turns
        twice = F.exists(frame[items], lambda t: t[names[0]].isNotNull() & t[names[1]].isNotNull())
        return F.when(~F.coalesce(twice, F.lit(False)), turns)
    made = [F.struct(F.lit(role).alias("role"), text(frame[field]).alias("text")) for role, field in mapping]
    optional = {"input", "system"} & set(layout)
    return F.filter(F.array(*made), lambda t: (t["text"] != "") | ~F.lit(bool(optional)))


def schema_of(layout: tuple[str, ...]) -> T.StructType:
    """The Spark type of a layout's field paths."""
    fields: dict[str, list[str]] = {}
    for path in layout:
        head, _, rest = path.partition("[].")
        fields.setdefault(head.removesuffix("[]"), []).extend([rest] if rest else [])
    inner = lambda names: T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in names]))
    return T.StructType([T.StructField(k, inner(v) if v else T.StringType()) for k, v in sorted(fields.items())])


def paths_in_json(record: Column) -> Column:
    """The field paths of a JSON record, to the depth that layouts have: every top field, and the fields of all elements of a list (``[]`` alone for an empty one)."""
    top = F.coalesce(F.json_object_keys(record), F.array().cast("array<string>"))
    values = F.from_json(record, "map<string,string>")

    def below(k: Column) -> Column:
        items = F.from_json(F.element_at(values, k), "array<string>")
        names = F.flatten(F.transform(items, lambda x: F.coalesce(F.json_object_keys(x), F.array().cast("array<string>"))))
        inside = F.transform(names, lambda x: F.concat(k, F.lit("[]."), x))
        return F.concat(F.array(k), F.when(F.size(items) == 0, F.array(F.concat(k, F.lit("[]")))).otherwise(F.coalesce(inside, F.array().cast("array<string>"))))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(top, below))))


def _allowed(known: set[str]) -> list[tuple[str, ...]]:
    """The layouts whose paths are all known, the most paths first."""
    return sorted((x for x in MAPPINGS if known.issuperset(x)), key=lambda x: -len(x))


def paths_in_struct(record: Column, kind: T.StructType) -> Column:
    """The field paths of a struct. Where its type allows one layout alone, nulls count as empty fields; where it allows several, a null field is absent."""
    paths = paths_of(kind)
    layouts = [set(x) for x in _allowed(set(paths))]
    if not [x for x in layouts[1:] if not x <= layouts[0]]:
        return F.array(*(F.lit(p) for p in paths))
    return F.array_compact(F.array(*(F.when(record[p.partition("[]")[0].partition(".")[0]].isNotNull(), F.lit(p)) for p in paths)))


def layout_of(paths: Column) -> Column:
    """The layout fingerprint: the hash of the paths of the layout that has all paths of ``paths`` which any layout has; null without one."""
    every = {p for x in MAPPINGS for p in x}
    spoken = F.array_intersect(paths, F.array(*(F.lit(p) for p in sorted(every) if not p.endswith("[]"))))
    whole = lambda listed: (F.size(F.array_except(listed, paths)) == 0) & (F.size(F.array_except(spoken, listed)) == 0)
    return F.coalesce(*(F.when(whole(F.array(*(F.lit(p) for p in layout))), fingerprint(layout)) for layout in _allowed(every)))


def canonical_turns(records: DataFrame, column: str = "record") -> DataFrame:
    """Adds ``fingerprint`` (of all paths), ``layout`` (of the mapping's paths) and ``turns``; ``column`` is a struct or a JSON string."""
    kind = records.schema[column].dataType
    record, listed = F.col(column), isinstance(kind, T.StringType)
    paths = paths_in_json(record) if listed else paths_in_struct(record, kind)
    allowed = _allowed({p for x in MAPPINGS for p in x} if listed else set(paths_of(kind)))
    found = records.withColumn("fingerprint", fingerprint(paths)).withColumn("layout", layout_of(paths))
    turns = F.lit(None).cast(f"array<{TURN}>")
    for layout in allowed:
        frame = F.from_json(record, schema_of(layout)) if listed else record
        turns = F.when(F.col("layout") == fingerprint(layout), _turns(frame, layout, MAPPINGS[layout])).otherwise(turns)
    return found.withColumn("turns", turns)


def unmapped(turned: DataFrame) -> DataFrame:
    """(fingerprint, n): records for which no mapping is declared."""
    return turned.where(F.col("turns").isNull()).groupBy("fingerprint").agg(F.count("*").alias("n"))


def conversations_to_records(rows: DataFrame) -> DataFrame:
    """Rows by turn as one record a conversation: ``conv_id, record<messages>``."""
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    listed = F.transform(F.array_sort(F.collect_list(turn)), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return rows.groupBy("conv_id").agg(F.struct(listed.alias("messages")).alias("record"))


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(F.regexp_replace(doubled, "#(?=##)", "#\\\\"), "<(?=/turn>)", "<\\\\")


def escape_role(role: Column) -> Column:
    return F.regexp_replace(escape(role), ":(?= )", ":\\\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


END = "</turn>\n"


def lines_of(turns: Column) -> Column:
    """(head, body) of each turn's line: what stands before the text, and the escaped text."""
    return F.transform(turns, lambda t: F.struct(F.concat(F.lit("### "), escape_role(t["role"]), F.lit(": ")).alias("head"), escape(t["text"]).alias("body"), t["role"].alias("role")))


def written(lines: Column) -> Column:
    """The formatted text of lines."""
    return F.array_join(F.transform(lines, lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")


def mask_of(lines: Column) -> Column:
    """The loss mask of lines: (turn, begin, end) of each assistant's text."""
    span = lambda t, k: F.struct(k.cast("int").alias("turn"), F.length(t["head"]).alias("begin"), (F.length(t["head"]) + F.length(t["body"])).alias("end"))
    return F.array_compact(F.transform(lines, lambda t, k: F.when(t["role"] == "assistant", span(t, k))))


def format_turns(turns: Column) -> Column:
    """The formatted text of canonical turns."""
    return written(lines_of(turns))


def masked_text(formatted: Column, mask: Column) -> Column:
    """All text under a loss mask, in order, read from the formatted text."""
    lines = F.split(formatted, END)
    part = lambda m: F.substr(F.element_at(lines, m["turn"] + 1), m["begin"] + 1, m["end"] - m["begin"])
    return F.array_join(F.transform(mask, lambda m: unescape(part(m))), "")


def parse(formatted: Column) -> Column:
    """The turns of a formatted text: the inverse of ``format_turns``."""
    parts = F.split(formatted, END)
    whole = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))

    def turn(part: Column) -> Column:
        at = F.instr(part, ": ")
        return F.struct(unescape(F.substr(part, F.lit(5), at - 5)).alias("role"), unescape(F.substr(part, at + 2)).alias("text"))

    return F.transform(whole, turn)


def loss_text(turns: Column) -> Column:
    """What assistants say, in order: what the text under the loss mask must be."""
    return F.array_join(F.transform(F.filter(turns, lambda t: t["role"] == "assistant"), lambda t: t["text"]), "")


def format_conversations(rows: DataFrame) -> DataFrame:
    """``conv_id, fingerprint, formatted, loss_mask`` of rows (conv_id, turn, role, text)."""
    turned = canonical_turns(conversations_to_records(rows)).select("conv_id", "fingerprint", lines_of(F.col("turns")).alias("lines"))
    return turned.select("conv_id", "fingerprint", written(F.col("lines")).alias("formatted"), mask_of(F.col("lines")).alias("loss_mask"))
