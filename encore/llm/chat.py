"""Chat formatting by token-level assembly.

A turn is ``<|im_start|> role <|im_sep|> text <|im_end|>``. The three markers
are reserved ids above the tokenizer's vocabulary; role and text are encoded
as separate segments and the reserved ids are spliced between them, so no
content can ever become a marker. In the formatted string, control strings in
content are escaped reversibly: ``<``, any backslashes and ``|`` get one more
backslash between. Masks come from marks at the segments' borders and a prefix
sum over them; the loss mask covers the ids of assistant texts.

Scale: turns are encoded where they lie, one row per turn; nothing collects a
conversation. The output has a row per turn with its number in the
conversation's order; digests read a conversation's turns as a sorted stream
in constant memory. A digest over a conversation's whole text is sequential
by its nature, so one task reads the rows of a hot conversation; decoding is
done before, spread over all tasks.

Cases: null text or role is empty; turns go by turn, then role and text, null
turns first; repeated rows are turns of their own; a null conv_id is a
conversation of its own; other columns are not read; empty tables give an
empty result.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import byte_buffer, long_lists, shuffle_partitions, written
from encore.llm.encoding import Encoder

MARKERS = ("<|im_start|>", "<|im_sep|>", "<|im_end|>")
_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def format_turns(conversations: DataFrame, tokenizer: str, *, conv: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text", learn_role: str = "assistant") -> DataFrame:
    """A row per turn: conv_id, turn, role and text order keys' hash, ``ids``
    and ``loss_mask`` (one 0 or 1 per id)."""
    types = {f.name: f.dataType.simpleString() for f in conversations.schema}

    def assembled(batches):
        encoder = Encoder.at(tokenizer, literal=True)
        start, sep, end = (encoder.vocabulary + i for i in range(3))
        for batch in batches:
            n = batch.num_rows
            roles = [r or "" for r in batch.column(2).to_pylist()]
            texts = [t or "" for t in batch.column(3).to_pylist()]
            segments = [s for r, t in zip(roles, texts) for s in (escape(r), escape(t))]
            ids, at = encoder.encode(*byte_buffer(pa.array(segments, pa.string())))
            # three markers a turn: before the role, between, after the text
            size = np.diff(at)
            each = size[0::2] + size[1::2] + 3
            begin = np.concatenate([[0], np.cumsum(each)])
            out = np.empty(begin[-1], np.int64)
            content = np.ones(begin[-1], bool)
            text_at = begin[:-1] + 2 + size[0::2]
            for place, marker in ((begin[:-1], start), (text_at - 1, sep), (begin[1:] - 1, end)):
                out[place] = marker
                content[place] = False
            out[content] = ids
            learned = np.array([r == learn_role for r in roles], bool)
            step = np.zeros(begin[-1] + 1, np.int32)
            np.add.at(step, text_at[learned], 1)
            np.add.at(step, begin[1:][learned] - 1, -1)
            mask = np.cumsum(step[:-1])
            yield pa.RecordBatch.from_pydict({
                conv: batch.column(0), turn: batch.column(1), "role": pa.array(roles), "tie": batch.column(4),
                "ids": long_lists(out, begin, pa.int32()), "loss_mask": long_lists(mask, begin, pa.int8())})

    # the text orders turns of equal number and role: its first characters, then a hash
    tie = F.concat(F.substring(F.coalesce(F.col(text), F.lit("")), 1, 64), F.lit("\x00"), F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    chosen = conversations.select(F.col(conv), F.col(turn), F.col(role).cast("string").alias("__role"),
                                  F.col(text).cast("string").alias("__text"), tie.alias("__tie"))
    return chosen.mapInArrow(assembled, f"`{conv}` {types[conv]}, `{turn}` {types[turn]}, role string, tie string,"
                                        " ids array<int>, loss_mask array<tinyint>")


def read_turns(formatted: DataFrame, tokenizer: str, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Turns read back from ids and masks alone: role, text, loss text (null
    without loss) and the number of characters of the formatted string."""
    types = {f.name: f.dataType.simpleString() for f in formatted.schema}

    def decoded(batches):
        encoder = Encoder.at(tokenizer, literal=True)
        start, sep, end = (encoder.vocabulary + i for i in range(3))
        marks = sum(map(len, MARKERS))
        for batch in batches:
            parts, loss = [], []
            for ids, mask in zip(batch.column(4), batch.column(5)):
                ids = np.asarray(ids.values)
                mask = np.asarray(mask.values)
                cut = int(np.flatnonzero(ids == sep)[0])
                assert ids[0] == start and ids[-1] == end
                parts += [ids[1:cut].tolist(), ids[cut + 1:-1].tolist()]
                loss.append(ids[mask > 0].tolist() if mask.any() else None)
            texts = encoder.tokenizer.decode_batch(parts, skip_special_tokens=False)
            lost = encoder.tokenizer.decode_batch([x or [] for x in loss], skip_special_tokens=False)
            yield pa.RecordBatch.from_pydict({
                conv: batch.column(0), turn: batch.column(1), "role_key": batch.column(2), "tie": batch.column(3),
                "role": pa.array([unescape(x) for x in texts[0::2]], pa.string()),
                "text": pa.array([unescape(x) for x in texts[1::2]], pa.string()),
                "loss": pa.array([None if x is None else unescape(t) for x, t in zip(loss, lost)], pa.string()),
                "chars": pa.array([len(a) + len(b) + marks for a, b in zip(texts[0::2], texts[1::2])], pa.int64())})

    return formatted.select(conv, turn, "role", "tie", "ids", "loss_mask").mapInArrow(
        decoded, f"`{conv}` {types[conv]}, `{turn}` {types[turn]}, role_key string, tie string, role string, text string,"
                 " loss string, chars long")


def digests(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Per conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    kind = turns.schema[conv].dataType.simpleString()

    def streamed(batches):
        def row():
            return [now, n, whole.hexdigest(), loss_chars, loss.hexdigest(), chars]

        begun, now = False, None
        for batch in batches:
            out = []
            for c, r, t, x, k in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if not begun or c != now:
                    if begun:
                        out.append(row())
                    begun, now, n, loss_chars, chars = True, c, 0, 0, 0
                    whole, loss = hashlib.sha256(), hashlib.sha256()
                n += 1
                whole.update(f"{r}\n{t}\n".encode())
                chars += k
                if x is not None:
                    loss.update(x.encode())
                    loss_chars += len(x)
            yield table(out)
        if begun:
            yield table([row()])

    names = [conv, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]
    schema = pa.schema(list(zip(names, [arrow, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()])))

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    return (turns.repartition(shuffle_partitions(turns.sparkSession), conv)
            .sortWithinPartitions(conv, turn, "role_key", "tie")
            .select(conv, "role", "text", "loss", "chars")
            .mapInArrow(streamed, f"`{conv}` {kind}, n_turns long, turns_sha256 string, loss_chars long,"
                                  " loss_sha256 string, formatted_chars long"))


def round_trip(conversations: DataFrame, tokenizer: str, conv: str = "conv_id", turn: str = "turn",
               role: str = "role", text: str = "text") -> DataFrame:
    """Format all turns into a table, read it back and digest it."""
    formatted = written(format_turns(conversations, tokenizer, conv=conv, turn=turn, role=role, text=text), "chat")
    return digests(read_turns(formatted, tokenizer, conv, turn), conv, turn)
