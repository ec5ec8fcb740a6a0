"""Chat formatting: records of many layouts become canonical turns and these a reversible training text.

A record is a JSON object. Its layout is recognised by a fingerprint, the hash of the nested field paths that any
mapping knows (``messages[].role``), so the order of fields and foreign extra fields play no part. The fingerprint
selects a declarative mapping, which says where the conversation's id, the roles and the texts are.

Template: ``<|turn|>role<|text|>text<|end|>`` per turn. Control strings inside roles and texts, these three and
those of common other templates, are broken with a backslash after their first character, and backslashes are
doubled, so the texts can be read back exactly and no text can imitate a turn.

Plan: records are mapped in the tasks that read them. One shuffle by conversation, sorted by turn within the
partition; formatting and digests then run over the sorted rows as a stream, so a conversation of any length takes
the memory of one Arrow batch. The digest of a conversation is sequential by definition, therefore one task reads
it; it holds no more of it than the running digests.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.text import batches, small_batches

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
# Control strings that must not appear in a text, the template's own first.
CONTROL = (
    TURN, TEXT, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>",
    "<|endoftext|>", "<|system|>", "<|user|>", "<|assistant|>", "<unk>", "<pad>",
)
_CONTROL = re.compile("|".join(re.escape(c) for c in sorted(CONTROL, key=len, reverse=True)))
_BROKEN = re.compile(r"\\(\\?)")


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps what a turn needs.

    ``turns`` names a list of objects with ``role`` and ``text`` fields; without it every entry of ``fixed`` gives
    a turn of that role from one field of the record, empty ones left out. ``position`` is the field that numbers a
    record that is itself one turn. ``names`` translates role names.
    """

    name: str
    key: str
    turns: str | None = None
    role: str | None = None
    text: str | None = None
    position: str | None = None
    fixed: tuple[tuple[str, str], ...] = ()
    names: dict[str, str] = field(default_factory=dict)

    def paths(self) -> frozenset[str]:
        inside = f"{self.turns}[]." if self.turns else ""
        own = {self.key, self.position, self.turns, self.turns and f"{self.turns}[]"}
        own |= {inside + f for f in (self.role, self.text) if f} | {f for _, f in self.fixed}
        return frozenset(p for p in own if p)


_SPOKEN = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
MAPPINGS = (
    Mapping("turn rows", "conv_id", role="role", text="text", position="turn"),
    Mapping("messages", "conv_id", turns="messages", role="role", text="content", names=_SPOKEN),
    Mapping("conversations", "conv_id", turns="conversations", role="from", text="value", names=_SPOKEN),
    Mapping("instruction", "conv_id", fixed=(("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Mapping("instruction without system", "conv_id", fixed=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Mapping("instruction only", "conv_id", fixed=(("user", "instruction"), ("assistant", "output"))),
    Mapping("prompt", "conv_id", fixed=(("user", "prompt"), ("assistant", "completion"))),
    Mapping("prompt and response", "conv_id", fixed=(("user", "prompt"), ("assistant", "response"))),
    Mapping("question", "conv_id", fixed=(("user", "question"), ("assistant", "answer"))),
)


def field_paths(value: object, prefix: str = "") -> set[str]:
    """Nested field paths of a parsed record; the elements of a list share the path ``name[]``."""
    if isinstance(value, dict):
        found = set()
        for name, inner in value.items():
            here = f"{prefix}{name}"
            found.add(here)
            found |= field_paths(inner, here + ("." if isinstance(inner, dict) else ""))
        return found
    if isinstance(value, list):
        found = {prefix + "[]"}
        for inner in value:
            found |= field_paths(inner, prefix + "[]" + ("." if isinstance(inner, dict) else ""))
        return found
    return set()


def fingerprint(paths: frozenset[str] | set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


class Layouts:
    """Mappings by the fingerprint of their paths; further fields of a record are ignored, also those that other mappings
    know: of the mappings whose paths a record has, the one with the most counts, the earlier of equals."""

    def __init__(self, mappings: tuple[Mapping, ...] = MAPPINGS) -> None:
        self.by_print = {fingerprint(m.paths()): m for m in mappings}
        self.by_size = sorted(mappings, key=lambda m: -len(m.paths()))
        self.known = frozenset().union(*(m.paths() for m in mappings))

    def select(self, record: dict) -> tuple[str, Mapping | None]:
        """Fingerprint and mapping. An empty or null list of turns has no element paths; the list is enough."""
        paths = field_paths(record) & self.known
        mark = fingerprint(paths)
        if mark not in self.by_print:
            for mapping in self.by_size:
                if mapping.paths() <= paths:
                    return fingerprint(mapping.paths()), mapping
            for own, mapping in self.by_print.items():
                empty = mapping.turns and record.get(mapping.turns) in (None, [])
                if empty and {mapping.key, mapping.turns} <= paths:
                    return own, mapping
        return mark, self.by_print.get(mark)


def _plain(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def turns_of(record: dict, mapping: Mapping) -> Iterator[tuple[int, str, str]]:
    """Canonical (turn, role, text) of one record."""
    if mapping.turns:
        for number, one in enumerate(record.get(mapping.turns) or []):
            one = one if isinstance(one, dict) else {}
            role = _plain(one.get(mapping.role))
            yield number, mapping.names.get(role, role), _plain(one.get(mapping.text))
    elif mapping.fixed:
        number = 0
        for role, name in mapping.fixed:
            if text := _plain(record.get(name)):
                yield number, role, text
                number += 1
    else:
        position = record.get(mapping.position)
        role = _plain(record.get(mapping.role))
        yield position, mapping.names.get(role, role), _plain(record.get(mapping.text))


CANONICAL = pa.schema([
    ("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("layout", pa.string()),
])
CANONICAL_DDL = "conv_id bigint, turn bigint, role string, text string, layout string"


_WHOLE = re.compile(r"\s*[+-]?[0-9]{1,19}\s*")
_SURROGATE = re.compile("[\ud800-\udfff]")
#: Why a record is left out, besides the fingerprint of a layout without a mapping.
MALFORMED, TOO_DEEP, NO_TURNS = "malformed", "nested too deep", "no turns"
BAD_KEY, BAD_TURN, BAD_TEXT = "no whole conv_id", "no whole turn", "lone surrogate"


def _whole(value: object) -> int | None:
    """A 64-bit integer from a number or text that is one; ValueError for anything else, null stays null."""
    if value is None:
        return None
    if isinstance(value, str) and _WHOLE.fullmatch(value) or isinstance(value, float) and value.is_integer():
        value = int(value)
    if not isinstance(value, int) or isinstance(value, bool) or not -(1 << 63) <= value < 1 << 63:
        raise ValueError(value)
    return value


def _read(value: str | None, layouts: Layouts) -> tuple[str, list[tuple] | None]:
    """(layout, turns) of a record, or (reason, None) for one that is left out."""
    try:
        record = json.loads(value) if value is not None else None
        if not isinstance(record, dict):
            return MALFORMED, None
        mark, mapping = layouts.select(record)
    except RecursionError:
        return TOO_DEEP, None
    except ValueError:
        return MALFORMED, None
    if mapping is None:
        return mark, None
    try:
        key = _whole(record.get(mapping.key))
    except ValueError:
        return BAD_KEY, None
    turns = []
    for turn, role, text in turns_of(record, mapping):
        try:
            turn = _whole(turn)
        except ValueError:
            return BAD_TURN, None
        if _SURROGATE.search(role) or _SURROGATE.search(text):
            return BAD_TEXT, None
        turns.append((key, turn, role, text, mapping.name))
    return (mapping.name, turns) if turns else (NO_TURNS, None)


def canonical_turns(records: DataFrame, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """(conv_id, turn, role, text, layout) from records, JSON objects in the column ``value``.

    Null texts and roles are empty strings. ``conv_id`` and ``turn`` are 64-bit integers: whole numbers and texts that are
    one are read as such, null stays null. A record that gives no turns is one row with null turn, role and text and the
    reason as the layout, so nothing is lost silently: the fingerprint of a layout without a mapping, ``malformed`` for
    what is no JSON object, ``nested too deep``, ``no whole conv_id`` or ``no whole turn``, ``lone surrogate`` for half a
    character in a role or text, ``no turns`` for an empty conversation. Other columns are ignored; no records give no
    turns.
    """

    def run(parts):
        layouts = Layouts(mappings)

        def rows():
            for part in parts:
                for value in part.column(0):
                    layout, turns = _read(value.as_py(), layouts)
                    yield from turns if turns is not None else [(None, None, None, None, layout)]

        yield from batches(CANONICAL, rows(), weigh=lambda row: len(row[3] or ""))

    small_batches(records)
    return records.select(F.col("value").cast("string").alias("value")).mapInArrow(run, CANONICAL_DDL)


def unmapped(records: DataFrame, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """(value, layout) of the records that ``canonical_turns`` leaves out, whole, with the reason as ``layout``: they are to
    be written beside the formatted conversations."""
    schema = pa.schema([("value", pa.string()), ("layout", pa.string())])

    def run(parts):
        layouts = Layouts(mappings)

        def rows():
            for part in parts:
                for value in part.column(0):
                    value = value.as_py()
                    layout, turns = _read(value, layouts)
                    if turns is None:
                        yield value, layout

        yield from batches(schema, rows(), weigh=lambda row: len(row[0] or ""))

    small_batches(records)
    return records.select(F.col("value").cast("string").alias("value")).mapInArrow(run, "value string, layout string")


def escaped(text: str) -> str:
    return _CONTROL.sub(lambda m: m.group()[0] + "\\" + m.group()[1:], text.replace("\\", "\\\\"))


def unescaped(text: str) -> str:
    return _BROKEN.sub(lambda m: m.group(1), text) if "\\" in text else text


FORMATTED = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int64()), ("formatted", pa.string()), ("loss_start", pa.int64()), ("loss_end", pa.int64()),
])
FORMATTED_DDL = "conv_id bigint, part bigint, formatted string, loss_start bigint, loss_end bigint"


def _each(parts) -> Iterator[tuple]:
    for part in parts:
        yield from zip(*(column.to_pylist() for column in part.columns), strict=True)


def _format(parts):
    def rows():
        key, part = object(), 0
        for conv, role, text in _each(parts):
            part = part + 1 if conv == key else 0
            key = conv
            head = TURN + escaped(role) + TEXT
            body = escaped(text)
            start, end = (len(head), len(head) + len(body)) if role == "assistant" else (None, None)
            yield conv, part, head + body + END, start, end

    yield from batches(FORMATTED, rows(), weigh=lambda row: len(row[2]))


def format_turns(turns: DataFrame) -> DataFrame:
    """The formatted conversations, a row per turn (records without a mapping are in ``unmapped``): concatenated in order of ``part`` they are the training text.

    ``loss_start`` and ``loss_end`` are code points within the row that the loss covers, the assistant's text;
    null for the other roles. Rows of a conversation are in order within one partition. Turns with equal numbers
    are ordered by role and text; null turn numbers come first.
    """
    ordered = (
        turns.filter("layout IS NULL OR role IS NOT NULL")
        .select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    )
    return ordered.select("conv_id", "role", "text").mapInArrow(_format, FORMATTED_DDL)


def read_part(formatted: str) -> tuple[str, str]:
    """(role, text) of one formatted turn."""
    if not formatted.startswith(TURN) or not formatted.endswith(END):
        raise ValueError("not a formatted turn")
    role, mark, text = formatted[len(TURN):-len(END)].partition(TEXT)
    if not mark:
        raise ValueError("a turn without a text mark")
    return unescaped(role), unescaped(text)


DIGESTS = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
])
DIGESTS_DDL = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)


def _digest(parts):
    def rows():
        key, n, chars, covered = None, 0, 0, 0
        whole, loss = hashlib.sha256(), hashlib.sha256()
        for conv, formatted, start, end in _each(parts):
            if n and conv != key:
                yield key, n, whole.hexdigest(), covered, loss.hexdigest(), chars
                n, chars, covered = 0, 0, 0
                whole, loss = hashlib.sha256(), hashlib.sha256()
            key = conv
            role, text = read_part(formatted)
            whole.update(f"{role}\n{text}\n".encode())
            n, chars = n + 1, chars + len(formatted)
            if start is not None:
                masked = unescaped(formatted[start:end])
                covered += len(masked)
                loss.update(masked.encode())
        if n:
            yield key, n, whole.hexdigest(), covered, loss.hexdigest(), chars

    yield from batches(DIGESTS, rows())


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, from the formatted rows alone (as ``format_turns`` leaves them, in order)."""
    return formatted.select("conv_id", "formatted", "loss_start", "loss_end").mapInArrow(_digest, DIGESTS_DDL)
