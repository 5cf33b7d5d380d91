"""Conversations formatted by a compiled template, and read back.

Turns are dealt by conversation and sorted, and each conversation is rendered turn
by turn, in the memory of one turn, however long it is: formatted text comes in
parts of about `PART_CHARS` code points that end between turns. The spans of a part
say which of its text is marked for generation, the loss mask.

Inside texts and roles control strings are escaped: a backslash is doubled, and one
is put behind the first character of whatever would be a control string. So none
is left whole inside a text, and reading back undoes it exactly.

Turns are ordered by number, then role and text; a missing number comes last. A null
text or role is empty. A null conversation id is one conversation. Repeated rows are
turns of their own. An empty table gives an empty result. Extra columns are ignored.

One conversation is one stream: a digest over all of it cannot be split. A
conversation with a third of all rows takes one task a third of the work, but never
more memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelweft.llm.chat_template import compile_template

PART_CHARS = 1 << 20
BATCH_CHARS = 1 << 22

BOS, EOS = "<s>", "</s>"
#: Strings that a text must not hold as they are; two characters at least.
CONTROL = (BOS, EOS, "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[TEXT]", "[/ROLE]")

TEMPLATE = """
{{- bos -}}
{%- for message in messages -%}
  {%- if message.role == 'user' -%}
    [INST] {{ message.text | escape }} [/INST]
  {%- elif message.role == 'assistant' -%}
    {{ ' ' }}{% generation %}{{ message.text | escape }}{% endgeneration %}{{ eos }}
  {%- elif message.role == 'system' -%}
    <<SYS>>{{ message.text | escape }}<</SYS>>
  {%- else -%}
    [ROLE]{{ message.role | escape }}[TEXT]{{ message.text | escape }}[/ROLE]
  {%- endif -%}
{%- endfor -%}
"""


def escaper(control: tuple[str, ...] = CONTROL) -> Callable[[str], str]:
    if any(len(c) < 2 or "\\" in c for c in control):
        raise ValueError("control strings have two characters at least and no backslash")
    begins = re.compile("|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in sorted(control)))
    return lambda text: begins.sub(lambda m: m[0] + "\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text) if "\\" in text else text


def read_turns(text: str, first: bool) -> Iterator[tuple[str, str]]:
    """Role and text of each turn of a formatted part."""
    at = len(BOS) if first else 0
    if first and not text.startswith(BOS):
        raise ValueError("a conversation begins with its mark")

    def upto(mark: str) -> str:
        nonlocal at
        end = text.index(mark, at)
        found, at = text[at:end], end + len(mark)
        return unescape(found)

    while at < len(text):
        for opening, closing, role in ((" ", EOS, "assistant"), ("[INST] ", " [/INST]", "user"), ("<<SYS>>", "<</SYS>>", "system")):
            if text.startswith(opening, at):
                at += len(opening)
                yield role, upto(closing)
                break
        else:
            if not text.startswith("[ROLE]", at):
                raise ValueError(f"no turn begins at {at}")
            at += len("[ROLE]")
            role = upto("[TEXT]")
            yield role, upto("[/ROLE]")


PARTS = "part int, last boolean, text string, spans array<struct<start:int,end:int>>"


def _renderer(source: str, control: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        template = compile_template(source, constants={"bos": BOS, "eos": EOS}, filters={"escape": escaper(control)})
        schema = None

        def rows():
            nonlocal schema
            for batch in batches:
                if schema is None:
                    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                    schema = pa.schema(
                        [batch.schema.field("conv_id"), ("part", pa.int32()), ("last", pa.bool_()), ("text", pa.string()), ("spans", spans)]
                    )
                yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")))

        def parts():
            for conv, turns in groupby(rows(), key=lambda r: r[0]):
                messages = ({"role": role, "text": text} for _, role, text in turns)
                n, held = 0, None
                for sheet in template.stream(messages=messages):
                    if sheet.size >= PART_CHARS:
                        if held is not None:
                            yield conv, n - 1, False, *held
                        held, n = sheet.take(), n + 1
                rest = sheet.take()
                if held is not None and rest[0]:
                    yield conv, n - 1, False, *held
                    held, n = None, n + 1
                yield (conv, n - 1, True, *held) if held is not None else (conv, max(0, n - 1), True, *rest)

        some, size = [], 0
        for row in parts():
            some.append(row)
            size += len(row[3])
            if size >= BATCH_CHARS:
                yield _batch(some, schema)
                some, size = [], 0
        if some:
            yield _batch(some, schema)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows))
    columns[4] = [[{"start": a, "end": b} for a, b in spans] for spans in columns[4]]
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def format_conversations(convs: DataFrame, source: str = TEMPLATE, control: tuple[str, ...] = CONTROL) -> DataFrame:
    """(conv_id, turn, role, text) -> conv_id, part, last, text, spans: the parts of
    a conversation come one after another, in order."""
    turns = convs.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    dealt = turns.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.col("turn").asc_nulls_last(), "role", "text"
    )
    kind = convs.schema["conv_id"].dataType.simpleString()
    return dealt.mapInArrow(_renderer(source, tuple(control)), f"conv_id {kind}, {PARTS}")


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    n_turns, loss_chars, chars = 0, 0, 0
    turns, loss = hashlib.sha256(), hashlib.sha256()
    for batch in batches:
        done = []
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "part", "last", "text", "spans"))
        for conv, part, last, text, spans in zip(*columns):
            if part == 0:
                n_turns, loss_chars, chars = 0, 0, 0
                turns, loss = hashlib.sha256(), hashlib.sha256()
            chars += len(text)
            for role, said in read_turns(text, part == 0):
                turns.update(f"{role}\n{said}\n".encode())
                n_turns += 1
            for span in spans:
                learned = unescape(text[span["start"] : span["end"]])
                loss.update(learned.encode())
                loss_chars += len(learned)
            if last:
                done.append((conv, n_turns, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))
        if done:
            kinds = [batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)


def read_back(formatted: DataFrame) -> DataFrame:
    """What the formatted text of each conversation says: its turns, and all text
    under the loss mask. The rows must be as `format_conversations` gives them, or
    sorted by conv_id and part within partitions that split no conversation. Works
    with the default template."""
    kind = formatted.schema["conv_id"].dataType.simpleString()
    return formatted.mapInArrow(
        _reader,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
