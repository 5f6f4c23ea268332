"""Chat formatting: conversations rendered by a compiled template, with a loss mask over what assistants say.

The template marks a turn as ``<|turn|>role<|text|>text<|end|>`` and a line break. Inside roles and texts a backslash
becomes two and ``<|`` becomes ``<\\|``, so no text holds a control string and every text can be read back exactly.
"""

import hashlib
import re
from collections.abc import Iterator
from functools import cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoor.llm.template import compile_stream, compile_template

#: The template of the query and its control strings.
TEMPLATE = (
    "{% for m in messages %}{{ '<|' + 'turn' + '|>' }}{{ m.role | escape }}<|text|>"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}{% else %}{{ m.text | escape }}{% endif %}"
    "<|end|>\n{% endfor %}"
)
TURN = re.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>\n", re.S)
#: Characters of a piece of a conversation, from which on it is given out at the end of a turn.
PIECE = 1 << 20
#: A conversation whose texts are another format's control strings.
PROBE = ((-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]"))


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


@cache
def renderer(template: str):
    return compile_template(template, {"escape": escape})


@cache
def streamer(template: str):
    return compile_stream(template, "messages", {"escape": escape})


def read_back(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted conversation."""
    return [(unescape(r), unescape(t)) for r, t in TURN.findall(formatted)]


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, dict]]:
    for batch in batches:
        for conv, role, text in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            yield conv, {"role": role.as_py() or "", "text": text.as_py() or ""}


def _in_order(rows: DataFrame) -> DataFrame:
    rows = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 1024) -> Iterator[pa.RecordBatch]:
    """Rows in batches of ``size``, fewer if their texts are long."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(x) for x in row if isinstance(x, str))
        if len(held) == size or chars > 4 * PIECE:
            yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def format_conversations(rows: DataFrame, template: str = TEMPLATE, piece: int = PIECE) -> DataFrame:
    """conv_id, start, formatted and loss_spans (array of start and end) of every conversation; places in its code points.

    Rows go by turn, then role, then text, nulls first; null roles and texts are empty. Rows whose conv_id is null are one
    conversation. A conversation is one row unless it is long: then it comes in pieces of ``piece`` characters and what ends
    the turn, of which ``start`` tells the place. One task renders a conversation, turn by turn, and holds a piece of it and not
    the whole; a template that asks for the messages twice holds them all. Other columns are not read; an empty table gives none.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("start", pa.int64()), ("formatted", pa.string()), ("loss_spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = streamer(template)
        groups = groupby(_turns(batches), key=lambda x: x[0])
        made = ((conv, *found) for conv, turns in groups for found in stream((t for _, t in turns), piece))
        yield from _batched(((c, start, text, [{"start": s, "end": e} for s, e in spans]) for c, start, text, spans in made), schema)

    return _in_order(rows).mapInArrow(run, "conv_id long, start long, formatted string, loss_spans array<struct<start:long,end:long>>")


def digests(formatted: DataFrame) -> DataFrame:
    """What :func:`format_conversations` gave, read back: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Pieces are taken in the order in which they were given; a conversation begins where ``start`` is nought.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from ((conv.as_py(), start.as_py(), text.as_py(), spans.as_py()) for conv, start, text, spans in zip(*batch.columns, strict=True))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        now = None
        for conv, start, text, spans in pieces(batches):
            if start == 0:
                if now is not None:
                    yield now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5]
                now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, said in read_back(text):
                now[1] += 1
                now[2].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
            for x in spans:
                loss = unescape(text[x["start"] - start : x["end"] - start])
                now[3] += len(loss)
                now[4].update(loss.encode("utf-8", "surrogatepass"))
            now[5] += len(text)
        if now is not None:
            yield now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(whole(batches), schema)

    return formatted.select("conv_id", "start", "formatted", "loss_spans").mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def with_probe(rows: DataFrame) -> DataFrame:
    """``rows`` and the probe's; rows that have its id already are of the same conversation."""
    probe = rows.sparkSession.createDataFrame(list(PROBE), "conv_id long, turn long, role string, text string")
    return rows.select("conv_id", "turn", "role", "text").unionByName(probe)


def oracle() -> str:
    """DuckDB SQL of the digests, with the formatted length by counting what is escaped."""
    esc = lambda c: f"length(replace(replace({c}, chr(92), chr(92) || chr(92)), '<|', '<' || chr(92) || '|'))"
    fixed = len("<|turn|><|text|><|end|>\n")
    return f"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({fixed} + {esc("role")} + {esc("text")}) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id"""
