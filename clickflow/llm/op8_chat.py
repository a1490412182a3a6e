"""Chat formatting through a black-box template.

A template is any function from a list of turns to a string. Each conversation is
rendered turn by turn: consecutive outputs are compared, what the longer prefix
adds is the turn's span, and an output that isn't a continuation of the one before
shows a template that rewrites history (``rewrites`` holds the first such turn;
its span starts where the outputs part). A second rendering of the last turn with
a probe in place of its text gives the place of the text inside the span. The loss
mask covers the texts of assistant turns.

The default template marks turns by ``<|im_start|>role\\n ... <|im_end|>\\n`` and
escapes control strings inside texts reversibly: every ``<|`` gets one more
backslash between its two characters.

The formatted conversations are written as Parquet (conv_id, formatted, spans,
rewrites) and the digests come from those files alone. Rows reach a task by
conversation, sorted by turn, and one conversation at a time is held: a template
needs it whole, it is the unit of the format.

Defined results: a null text or role is empty; rows without conv_id are one
conversation; turns that tie are ordered by role and text, repeated rows are
repeated turns; an empty table gives the probe conversation -1 alone; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import scratch_path

START, END = "<|im_start|>", "<|im_end|>"
PROBE_TEXT = f"{END}{START}assistant ok"
PROBE_ROWS = [(-1, 0, "user", PROBE_TEXT), (-1, 1, "assistant", PROBE_TEXT)]

SPANS = "ARRAY<STRUCT<start: BIGINT, text_start: BIGINT, text_end: BIGINT, `end`: BIGINT, loss: BOOLEAN>>"
FORMATTED = f"conv_id BIGINT, formatted STRING, spans {SPANS}, rewrites BIGINT"
FORMATTED_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("formatted", pa.string()),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("text_start", pa.int64()), ("text_end", pa.int64()),
                                  ("end", pa.int64()), ("loss", pa.bool_())]))), ("rewrites", pa.int64())])


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def _role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unrole(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(text))


def chat_template(turns: list[tuple[str, str]]) -> str:
    return "".join(f"{START}{_role(r)}\n{escape(t)}{END}\n" for r, t in turns)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a string that ``chat_template`` made."""
    out = []
    for piece in formatted.split(START)[1:]:
        role, _, text = piece.removesuffix(f"{END}\n").partition("\n")
        out.append((_unrole(role), unescape(text)))
    return out


def _common(a: str, b: str) -> int:
    return len(a) if b.startswith(a) else len(os.path.commonprefix((a, b)))


def render(turns: list[tuple[str, str]], template: Callable = chat_template):
    """(output, spans, first turn that rewrites history or None); a span is
    (start, text start, text end, end, loss)."""
    spans, rewrites, before = [], None, template([])
    for i, (role, text) in enumerate(turns):
        now = template(turns[: i + 1])
        start = _common(before, now)
        if start < len(before) and rewrites is None:
            rewrites = i
        probe = "qzprobe"
        while probe in now:
            probe += "qz"
        other = template([*turns[:i], (role, probe)])
        at = other.rfind(probe)
        a, b = (at, len(now) - (len(other) - at - len(probe))) if at >= 0 else (len(now), len(now))
        spans.append((start, a, max(a, b), len(now), role == "assistant"))
        before = now
    return before, spans, rewrites


def format_conversations(conversations: DataFrame, path: str, template: Callable = chat_template) -> None:
    """Write the formatted conversations below ``path``."""
    def one(conv, turns):
        text, spans, rewrites = render(turns, template)
        return {"conv_id": conv, "formatted": text, "rewrites": rewrites, "spans": [
            dict(zip(("start", "text_start", "text_end", "end", "loss"), s)) for s in spans]}

    def run(batches):
        conv, turns, out, size = None, [], [], 0
        for batch in batches:
            for c, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
                if turns and c != conv:
                    out.append(one(conv, turns))
                    size += len(out[-1]["formatted"])
                    turns = []
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(out, FORMATTED_ARROW)
                        out, size = [], 0
                conv = c
                turns.append((role or "", text or ""))
        if turns:
            out.append(one(conv, turns))
        if out:
            yield pa.RecordBatch.from_pylist(out, FORMATTED_ARROW)

    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    (rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
     .mapInArrow(run, FORMATTED).write.parquet(path))


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, rewrites from the files below ``path``."""
    def run(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                text = row["formatted"]
                turns = parse(text)
                loss = "".join(unescape(text[s["text_start"]: s["text_end"]]) for s in row["spans"] if s["loss"])
                out.append((row["conv_id"], len(turns),
                            hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                            len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text), row["rewrites"]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], t) for i, t in enumerate(
                    (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites"])

    return spark.read.schema(FORMATTED).parquet(path).mapInArrow(
        run, "conv_id BIGINT, n_turns BIGINT, turns_sha256 STRING, loss_chars BIGINT, loss_sha256 STRING, "
             "formatted_chars BIGINT, rewrites BIGINT")


def formatted_digests(conversations: DataFrame, path: str | None = None) -> DataFrame:
    """Format ``conversations`` (conv_id, turn, role, text) and the probe conversation, and read them back."""
    spark = conversations.sparkSession
    path = path or scratch_path(spark, "chat")
    probe = spark.createDataFrame(PROBE_ROWS, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    rows = conversations.selectExpr("CAST(conv_id AS BIGINT) AS conv_id", "CAST(turn AS BIGINT) AS turn",
                                    "CAST(role AS STRING) AS role", "CAST(text AS STRING) AS text")
    format_conversations(rows.union(probe), path)
    return read_digests(spark, path)
