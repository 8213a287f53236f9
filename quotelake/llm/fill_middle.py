"""Fill-in-the-middle documents as piece tables.

A document is a list of descriptors, each a range of an immutable buffer: the text, or the one
buffer that holds the sentinels. Cutting splits a descriptor, an arrangement permutes the list,
and only what leaves a task is spelled out. Reading an output back is the same in reverse: the
output is the buffer, the sentinels show where to cut it, and the inverse permutation gives the
descriptors of the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.shared import text_runs

# The sentinels before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = SENTINELS = ("<P>", "<S>", "<M>")
#: Places of prefix (0), middle (1) and suffix (2) in the output, by form; each follows its sentinel.
ORDERS = {"psm": (0, 2, 1), "spm": (2, 0, 1)}
BEFORE = {0: PREFIX, 1: MIDDLE, 2: SUFFIX}

RUN_CHARS = 1 << 22  # characters of the documents that leave a task together
MADE_SCHEMA = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string, output_sha256 string"
REBUILT_SCHEMA = "restored string, restored_sha256 string"


@dataclass(frozen=True)
class Piece:
    """Code points `start` to `stop` of a buffer."""

    buffer: str
    start: int
    stop: int

    def cut(self, *places: int) -> list[Piece]:
        """The piece split at offsets of its own, in ascending order."""
        edges = [self.start, *(self.start + p for p in places), self.stop]
        return [Piece(self.buffer, a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]

    def text(self) -> str:
        return self.buffer[self.start : self.stop]


_MARKS = "".join(SENTINELS)
_MARK = {s: Piece(_MARKS, _MARKS.index(s), _MARKS.index(s) + len(s)) for s in SENTINELS}


def digest(pieces: list[Piece]) -> str:
    """SHA-256 of the text of all pieces in UTF-8, fed piece by piece."""
    state = hashlib.sha256()
    for piece in pieces:
        state.update(piece.text().encode())
    return state.hexdigest()


def unit_starts(text: str) -> np.ndarray:
    """Offsets at which units begin: a run of ASCII letters is one, any other code point is one."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    letter = ((points | 32) >= 97) & ((points | 32) <= 122)
    begins = ~letter
    begins[1:] |= ~letter[:-1]
    begins[:1] = True
    return np.flatnonzero(begins)


def draws(doc_id: int | None) -> list[int]:
    """The first four 32-bit numbers of the hash that decides about a document; a null id counts as no digits."""
    head = hashlib.sha256(b"1:" + (b"" if doc_id is None else str(doc_id).encode())).digest()[:16]
    return [int.from_bytes(head[i : i + 4], "big") for i in range(0, 16, 4)]


def arrange(text: str, doc_id: int | None) -> tuple[int, str, list[Piece], list[Piece]]:
    """Units, form, the pieces of the output, and those of prefix, middle and suffix (none if plain)."""
    starts, whole = unit_starts(text), Piece(text, 0, len(text))
    n = len(starts)
    h1, h2, h3, h4 = draws(doc_id)
    if not text or h3 % 100 >= 90 or any(s in text for s in SENTINELS):
        return n, "plain", [whole], []
    edges = [int(starts[u]) if u < n else len(text) for u in sorted((h1 % (n + 1), h2 % (n + 1)))]
    parts = whole.cut(*edges)
    form = "spm" if h4 % 100 < 20 else "psm"
    return n, form, [p for i in ORDERS[form] for p in (_MARK[BEFORE[i]], parts[i])], parts


def rearrange(output: str, form: str | None) -> list[Piece] | None:
    """The pieces of the text that an output was made of, or None if it has not that form."""
    whole = Piece(output, 0, len(output))
    if form == "plain":
        return [whole]
    if form not in ORDERS:
        return None
    edges, at = [], 0
    for i in ORDERS[form]:
        found = output.find(BEFORE[i], at)
        if found < 0 or (not edges and found):
            return None
        at = found + len(BEFORE[i])
        edges += [found, at]
    held = whole.cut(*edges)[2::2]  # what follows each sentinel
    parts = [held[0]] * 3
    for place, i in enumerate(ORDERS[form]):
        parts[i] = held[place]
    return parts


def _spelled(pieces: list[Piece]) -> str:
    return "".join(p.text() for p in pieces)


def _make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1)
        for own in text_runs(texts.to_pylist(), RUN_CHARS):
            rows = []
            for doc_id, text in zip(ids[own], texts[own.start : own.stop].to_pylist(), strict=True):
                n, form, pieces, parts = arrange(text or "", doc_id)
                sizes = [p.stop - p.start for p in parts[:2]] or [None, None]
                rows.append((doc_id, n, form, *sizes, _spelled(pieces), digest(pieces)))
            yield _table(rows, MADE_TYPES)


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        outputs, forms = batch.column("_output"), batch.column("_form").to_pylist()
        for own in text_runs(outputs.to_pylist(), RUN_CHARS):
            texts = outputs[own.start : own.stop].to_pylist()
            pieces = [None if t is None else rearrange(t, f) for t, f in zip(texts, forms[own], strict=True)]
            rows = [(None, None) if p is None else (_spelled(p), digest(p)) for p in pieces]
            made = _table(rows, REBUILT_TYPES)
            held = batch.slice(own.start, own.stop - own.start).drop_columns(["_output", "_form"])
            yield pa.RecordBatch.from_arrays([*held.columns, *made.columns], [*held.schema.names, *made.schema.names])


def _types(schema: str) -> list[tuple[str, pa.DataType]]:
    return [(n, pa.int64() if t == "bigint" else pa.string()) for n, t in (c.split(" ") for c in schema.split(", "))]


MADE_TYPES, REBUILT_TYPES = _types(MADE_SCHEMA), _types(REBUILT_SCHEMA)


def _table(rows: list[tuple], types: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, types, strict=True)], [n for n, _ in types])


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """`doc_id, n, form, prefix_chars, middle_chars, output, output_sha256` for every row of `docs` (`doc_id, text`).

    `n` counts the units of the whole text. What is cut where, and which form is taken, follows from
    `doc_id` and `n` alone, so repeated rows give repeated outputs. A null text counts as empty;
    empty texts and texts that hold a sentinel stay plain. A null id is hashed as no digits. Other
    columns are not read. One document is held at a time, besides some megabytes of finished ones.
    """
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(_make, MADE_SCHEMA)


def restore(made: DataFrame, keep: list[str]) -> DataFrame:
    """The columns `keep` of `made` (`form, output`) with `restored`, the text that `output` was made of,
    and `restored_sha256`. Both are NULL where output or form is null or the output has not that form."""
    clash = {"restored", "restored_sha256", "_output", "_form"} & set(keep)
    if clash:
        raise ValueError(f"columns to keep have names of the result: {sorted(clash)}")
    held = made.select(*keep, F.col("output").alias("_output"), F.col("form").alias("_form"))
    kinds = ", ".join(f"`{c}` {t}" for c, t in made.select(*keep).dtypes)
    return held.mapInArrow(_rebuild, ", ".join(filter(None, [kinds, REBUILT_SCHEMA])))
