"""Exact removal of repeated byte strings: prefix doubling over sampled positions.

The name of the string of length 2m at a position is made of the names of length m at the position
and m further on, so names of 8 bytes double to 16, 32 and 64; equal strings have equal names
everywhere, which lets them stand for ranks. To find strings of `length` bytes that occur earlier:

1. Each window of `length` bytes has an anchor, the place of its smallest 32-byte name. Equal
   windows have equal anchors at equal places, so only anchors are sorted (one for about 35 bytes).
   All windows with one anchor form a stretch. An anchor whose name is unique ends here, and so
   does a stretch that is an exact copy of an earlier one: all of it is removed.
2. What is left are first stretches whose anchor also stands in a different stretch: the edges of
   repeated passages. They are cut into groups of eight windows, counted from the anchor, and sorted
   again by the pair of names that covers what the eight share: unique ones end, copies go.
3. The windows of the groups that are still open are sorted by the pair of names that covers each;
   of equal windows all but the first are removed.

What repeats within one batch of a task is settled there, so that a string that stands in a third of
all documents reaches the sort once for each batch, and no task has to hold its group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelake.llm.grams import U64, mix, salt
from quotelake.llm.shared import stored

SEED = 32  # bytes of an anchor
GROUP = 8  # windows that are sorted together in the second step
RUN_BYTES = 1 << 20
#: Rows of a sort: settled (a removed range), a stretch, a stretch whose name is known to have
#: several, and the news of that for the other rows of the name.
SETTLED, SINGLE, SEVERAL, NEWS = 0, 1, 2, 3
#: `name`; `packed`: the stretch's own name (48 bits), windows less one (7), place of the anchor (7),
#: kind (2), or for a settled row its length (62) and kind; `place`: tie (32 bits) and start (32).
CUT_SCHEMA = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, spans array<struct<start:int,stop:int>>, kept binary"
ROW_SCHEMA = "name bigint, packed bigint, doc_id bigint, place bigint"


def names(data: np.ndarray, upto: int) -> dict[int, np.ndarray]:
    """The names of the strings of 8, 16, .. `upto` bytes at every position; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(upto + 8, np.uint8)])
    size = len(data) + upto - 8
    first = np.empty(size, U64)
    for shift in range(8):
        count = len(first[shift::8])
        first[shift::8] = np.frombuffer(padded.data, "<u8", count, shift)
    found, m = {8: first}, 8
    while m < upto:
        a = found[m]
        # Of two names the second is turned first, so that the pair has an order.
        found[2 * m] = mix(a[:-m] * salt(m) + mix(a[m:] + salt(m + 1)))
        m *= 2
    return {m: a[: len(data)] for m, a in found.items()}


def stretches(smallest: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, last window and anchor of every stretch; `smallest` has the 32-byte names."""
    width, n = length - SEED + 1, len(smallest)
    valid = np.zeros(n + 1, bool)
    edges = np.zeros(n + 1, np.int64)
    lengths = np.diff(starts)
    fit = lengths >= length
    np.add.at(edges, starts[:-1][fit], 1)
    np.add.at(edges, starts[1:][fit] - length + 1, -1)
    valid[:n] = np.cumsum(edges)[:n] > 0
    if not valid.any():
        return (np.zeros(0, np.int64),) * 3
    least, span = smallest, 1
    padded = np.concatenate([smallest, np.full(width, np.iinfo(U64).max)])
    least = padded
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[:n], least[width - span : width - span + n])
    change = np.ones(n, bool)
    change[1:] = least[1:] != least[:-1]
    change |= np.diff(valid[:n].view(np.int8), prepend=np.int8(0)) != 0
    first = np.flatnonzero(change)
    last = np.append(first[1:], n) - 1
    first, last = first[valid[first]], last[valid[first]]
    view = np.lib.stride_tricks.sliding_window_view(padded, width)

    def anchors(at):
        return np.concatenate([view[at[i : i + 50_000]].argmin(1) for i in range(0, len(at), 50_000)] or [at]) + at

    anchor = anchors(first)
    # The anchor left of a window's start is lost to it, and an equal name further on takes over.
    late = last > anchor
    if late.any():
        gaps = last[late] - anchor[late]
        ends = np.cumsum(gaps)
        more = np.repeat(anchor[late] + 1 - ends + gaps, gaps) + np.arange(ends[-1])
        first, last = np.concatenate([first, more]), np.concatenate([np.minimum(last, anchor), more])
        anchor = np.concatenate([anchor, anchors(more)])
    return first, last, anchor


def _merged(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping and touching ranges of one document as one."""
    if not len(doc):
        return doc, start, stop
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    # Shifting each document's ranges behind those of the one before makes it one line.
    shift = doc * (int(stop.max()) + 2)
    reach = np.maximum.accumulate(stop + shift)
    fresh = np.ones(len(doc), bool)
    fresh[1:] = start[1:] + shift[1:] > reach[:-1]
    at = np.flatnonzero(fresh)
    end = np.append(at[1:], len(doc)) - 1
    return doc[at], start[at], reach[end] - shift[at]


class _Batch:
    """One batch of documents in the order that decides which copy is the first."""

    def __init__(self, doc_ids: pa.Array, ties: pa.Array, texts: pa.Array):
        self.doc_ids, self.ties = doc_ids, ties
        key = (doc_ids.fill_null(-(2**63)).to_numpy(zero_copy_only=False), ties.to_numpy(zero_copy_only=False))
        filled = ~doc_ids.is_null().to_numpy(zero_copy_only=False)
        order = np.lexsort((key[1], key[0], filled))
        different = np.zeros(len(order), np.int64)
        for k in (filled, *key):
            different[1:] |= k[order][1:] != k[order][:-1]
        self.place = np.empty(len(order), np.int64)  # equal for rows that repeat
        self.place[order] = np.cumsum(different)
        binary = texts.cast(pa.large_binary()).fill_null(b"")
        _, offsets, data = binary.buffers()
        self.starts = np.frombuffer(offsets, np.int64, len(binary) + 1, 8 * binary.offset)
        self.data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)

    def runs(self) -> Iterator[tuple[int, int]]:
        """Rows that are worked on together: up to RUN_BYTES, or one longer document."""
        row, count = 0, len(self.starts) - 1
        while row < count:
            stop = int(np.searchsorted(self.starts, self.starts[row] + RUN_BYTES, "right")) - 1
            yield row, max(stop, row + 1)
            row = max(stop, row + 1)

    def columns(self, rows: np.ndarray) -> list[pa.Array]:
        at = pa.array(rows)
        return [self.doc_ids.take(at), self.ties.take(at)]


def _first_of_group(columns: tuple[np.ndarray, ...], place: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether a row is the first, by place and start, of those with equal `columns`; ties all are."""
    order = np.lexsort((start, place, *columns[::-1]))
    fresh = np.zeros(len(order), bool)
    fresh[:1] = True
    for c in columns:
        fresh[1:] |= c[order][1:] != c[order][:-1]
    lead = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
    first = np.empty(len(order), bool)
    first[order] = (place[order] == place[order][lead]) & (start[order] == start[order][lead])
    return first


def _rows(own: _Batch, length: int, found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """The rows to sort for stretches (name, own name, row, first window, windows, place of the
    anchor), after settling what repeats within the batch."""
    name, whole, row, start, count, anchor = (np.concatenate(c) for c in zip(*found, strict=True))
    whole = whole >> U64(16)
    first = _first_of_group((name, whole), own.place[row], start)
    doc, done_start, done_stop = _merged(row[~first], start[~first], (start + count - 1 + length)[~first])
    name, whole, row, start, count, anchor = (c[first] for c in (name, whole, row, start, count, anchor))
    # Names with different stretches: their rows are dealt out by stretch, and one row brings the news.
    order = np.argsort(name, kind="stable")
    fresh = np.ones(len(order), bool)
    fresh[1:] = name[order][1:] != name[order][:-1]
    heads = np.flatnonzero(fresh)
    low, high = (f.reduceat(whole[order], heads) if len(order) else whole for f in (np.minimum, np.maximum))
    several = np.empty(len(order), bool)
    several[order] = (low != high)[np.cumsum(fresh) - 1]
    news = order[heads][low != high]
    kind = np.where(several, SEVERAL, SINGLE)
    packed = (whole << U64(16)) | ((count - 1) << 9 | anchor << 2 | kind).astype(U64)
    keys = [mix(doc.astype(U64) * salt(3) + done_start.astype(U64)), np.where(several, mix(name + whole), name), name[news]]
    rows = np.concatenate([doc, row, row[news]])
    starts = np.concatenate([done_start, start, np.zeros(len(news), np.int64)])
    at = pa.array(rows)
    tie = own.ties.take(at).to_numpy(zero_copy_only=False).astype(np.int64)
    values = [((done_stop - done_start) << 2).astype(U64), packed, np.full(len(news), NEWS, U64)]
    return pa.record_batch([
        pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(values).view(np.int64)),
        own.doc_ids.take(at), pa.array((tie << 32) | starts),
    ], ["name", "packed", "doc_id", "place"])


def _anchors(length: int):
    """First step: the stretches of all documents."""

    def run(batches):
        for batch in batches:
            own, found = _Batch(*batch.columns), []
            for a, b in own.runs():
                base = own.starts[a]
                starts = own.starts[a : b + 1] - base
                if not (np.diff(starts) >= length).any():
                    continue
                named = names(own.data[base : own.starts[b]], 64)
                first, last, anchor = stretches(named[32], starts, length)
                long, stop = named[64], last + length
                # Three overlapping names and both lengths stand for the whole stretch.
                whole = mix(long[first] + salt(1)) + mix(long[first + (stop - first - 64) // 2] + salt(2))
                whole = mix(whole + mix(long[stop - 64] + ((anchor - first) * 1000 + last - first).astype(U64)))
                row = np.searchsorted(starts, first, "right") - 1
                found.append((named[32][anchor], whole, row + a, first - starts[row], last - first + 1, anchor - first))
            if found:
                yield _rows(own, length, found)

    return run


def _edges(length: int, group: int):
    """Second and third step: the open stretches of each document in groups of windows, or one by one."""

    def run(batches):
        for batch in batches:
            own, found = _Batch(*batch.columns[:3]), []
            ranges, flat = batch.column(3), batch.column(3).flatten()
            held = np.diff(ranges.offsets.to_numpy())
            fields = [flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)]
            rows = np.repeat(np.arange(len(ranges)), held)
            for i in range(0, len(rows), 5_000):
                row, (low, high, anchor) = rows[i : i + 5_000], (f[i : i + 5_000] for f in fields)
                sizes = high - low
                ends = np.cumsum(sizes)
                data = own.data[np.repeat(own.starts[row] + low - ends + sizes, sizes) + np.arange(ends[-1])]
                long = names(data, 64)[64]
                # Groups are counted from the anchor, so that equal windows are in equal groups.
                head, tail = -anchor // group, (sizes - length - anchor) // group
                count = tail - head + 1
                upto = np.cumsum(count)
                which = np.repeat(np.arange(len(row)), count)
                inner = np.arange(upto[-1]) - (upto - count)[which] + head[which]
                base = (ends - sizes)[which]
                middle = anchor[which] + inner * group
                first = np.maximum(middle, 0)
                last = np.minimum(middle + group - 1, (sizes - length)[which])
                # The bytes that all windows of a whole group share lie in each window of it.
                name = mix(long[base + middle + group - 1] + mix(long[base + middle + length - 64] + salt(4)))
                whole = mix(long[base + first] + mix(long[base + last + length - 64] + salt(5)))
                whole = mix(whole + ((first - middle) * 100 + last - first).astype(U64))
                found.append((name, whole, row[which], low[which] + first, last - first + 1, np.zeros(len(which), np.int64)))
            if found:
                yield _rows(own, length, found)

    return run


def cut_ranges(batches):
    """The ranges of each document merged, and the bytes outside of them."""
    for batch in batches:
        own, out = _Batch(*batch.columns[:3]), []
        for row, ranges in enumerate(batch.column(3).to_pylist()):
            data = own.data[own.starts[row] : own.starts[row + 1]]
            start, stop = (np.array([r[k] for r in ranges or []], np.int64) for k in ("start", "stop"))
            _, start, stop = _merged(np.zeros(len(start), np.int64), start, stop)
            edges = np.zeros(len(data) + 1, np.int64)
            edges[start] += 1
            edges[stop] -= 1
            kept = data[np.cumsum(edges)[:-1] == 0]
            spans = [{"start": a, "stop": b} for a, b in zip(start.tolist(), stop.tolist(), strict=True)]
            out.append((len(data), len(data) - len(kept), len(spans), spans, kept.tobytes()))
        columns = list(zip(*out, strict=True)) or [()] * 5
        span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        yield pa.record_batch(
            [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], span), pa.array(columns[4], pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"],
        )


def remove_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """`doc_id, n_bytes, n_removed, n_spans, spans, kept` for every row of `docs` (`doc_id, text`).

    Texts are taken as UTF-8 bytes, a null one as empty. A byte is removed if it lies in a string of
    `length` bytes (from 80 to 128) that also starts earlier: in a document before it, or further
    up in its own. Documents are ordered by id, a null id first, and those that share an id by a hash
    of their text; rows that repeat id and text are one document, with a row each in the result.
    Strings are judged on the input and never reach across documents. `spans` are the removed ranges
    and `kept` the remaining bytes. Other columns are not read.
    """
    if not 80 <= length <= 128:
        raise ValueError("length must be from 80 to 128")
    source = documents(docs)

    def with_ranges(rows: DataFrame, how: str, *columns: str) -> DataFrame:
        rows = rows.groupBy("doc_id", "tie").agg(F.collect_list(F.struct(*columns)).alias("ranges"))
        same = (source["doc_id"] == rows["doc_id"]) & (source["tie"] == rows["tie"])
        return source.join(rows, same, how).select(source["doc_id"], source["tie"], "text", "ranges")

    def still_open(found: DataFrame) -> DataFrame:
        return with_ranges(found.where("open"), "inner", "start", "stop", "anchor")

    first = stored(_judged(source.mapInArrow(_anchors(length), ROW_SCHEMA), length), "stretches")
    second = _judged(still_open(first).mapInArrow(_edges(length, GROUP), ROW_SCHEMA), length)
    third = _judged(still_open(second).mapInArrow(_edges(length, 1), ROW_SCHEMA), length)
    removed = [found.where("not open").select("doc_id", "tie", "start", "stop") for found in (first, second, third)]
    everything = removed[0].unionByName(removed[1]).unionByName(removed[2])
    return with_their_ids(with_ranges(everything, "left", "start", "stop")).mapInArrow(cut_ranges, CUT_SCHEMA)


def documents(docs: DataFrame) -> DataFrame:
    """`doc_id, tie, text`; both numbers together stand for a document. A null id is replaced by a hash of the
    text, and told apart by the last bit of the tie."""
    text, given = F.col("text").cast("string"), F.col("doc_id").cast("bigint")
    tie = F.hash(text).bitwiseAND(-2).bitwiseOR(given.isNull().cast("int"))
    return docs.select(F.coalesce(given, F.xxhash64(text)).alias("doc_id"), tie.alias("tie"), text.alias("text"))


def has_no_id() -> Column:
    return F.col("tie").bitwiseAND(1) == 1


def with_their_ids(rows: DataFrame) -> DataFrame:
    return rows.withColumn("doc_id", F.when(~has_no_id(), F.col("doc_id")))


def _judged(rows: DataFrame, length: int) -> DataFrame:
    """`doc_id, tie, start, stop, anchor, open` of removed ranges, and of first stretches (open)
    whose name has others."""
    kind = F.col("packed").bitwiseAND(3)
    settled = kind == SETTLED
    count = F.shiftright("packed", 9).bitwiseAND(127) + 1
    # Dealt out before the row is taken apart, so that only the packed one travels.
    apart = rows.repartition("name").select(
        "name", "doc_id", "place", kind.alias("kind"), F.shiftrightunsigned("packed", 16).alias("stretch"),
        F.shiftright("place", 32).cast("int").alias("tie"), F.col("place").bitwiseAND(0xFFFFFFFF).cast("int").alias("start"),
        F.when(settled, F.shiftright("packed", 2)).otherwise(count + (length - 1)).cast("int").alias("size"),
        F.when(settled, 0).otherwise(F.shiftright("packed", 2).bitwiseAND(127)).cast("int").alias("anchor"),
    )
    order = [has_no_id().desc(), "doc_id", "place"]
    whole = Window.partitionBy("name").orderBy("stretch", *order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stretch = F.when(F.col("kind") != NEWS, F.col("stretch"))
    several = (F.max("kind").over(whole) >= SEVERAL) | (F.min(stretch).over(whole) != F.max(stretch).over(whole))
    copy = F.rank().over(Window.partitionBy("name", "stretch").orderBy(*order)) > 1
    return (
        apart.withColumns({"several": several, "copy": copy})
        .where(f"kind = {SETTLED} or (kind in ({SINGLE}, {SEVERAL}) and (copy or several))")
        .select("doc_id", "tie", "start", F.expr("start + size").alias("stop"), "anchor", F.expr(f"kind <> {SETTLED} and not copy").alias("open"))
    )
