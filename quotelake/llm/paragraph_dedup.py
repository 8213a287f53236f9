"""Repeated paragraphs: MinHash banding, exact verification, removal by components.

A paragraph is a line with enough words, or a block: successive shorter lines that have enough words
together. Paragraphs that agree in a band of their MinHash signature are candidates; the bands are
tuned for recall (at similarity 0.8 one pair in 100,000 is missed), and each link is verified by the
exact Jaccard similarity of the five-word shingles. Of every component the first paragraph stays, all
others are cut out of their documents. A shorter line is never judged alone: it goes as part of
a run of lines that all stand elsewhere, too, and have enough words together.

Passages that repeat across or inside lines are found by windows of words. Of STEP windows in a row
the one with the least hash is compared, so equal passages choose equal windows wherever they stand.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.grams import (
    RUN_CHARS, U64, mix, runs_of_words, salt, shingles, sort_segments, word_hashes, word_places,
)
from quotelake.llm.near import band_keys, gram_sets, group_units, lists, sequence_names, shared_buckets, unit_names
from quotelake.llm.shared import keyed, release, stored, text_runs, tidy, with_found, written
from quotelake.session import remove_path

ROWS, BANDS = 3, 16
#: Words that make a line, a block or a run of shorter lines a paragraph.
LEAST_WORDS = 40
#: The shortest line that has a shingle of five words; shorter ones stay where they are.
SHORTEST = 5
#: Words of a window. A repeated run of WINDOW + STEP - 1 = 51 words holds a chosen window, and of a longer one
#: at most STEP - 1 words at either end lie in none.
WINDOW, STEP = 36, 16
SET_SCHEMA = "unit binary, n int, bits array<bigint>, grams binary"
PLACE_SCHEMA = "unit binary, doc_id bigint, row bigint, tie int, paragraph int, lines int, words int, bands array<bigint>"
WINDOW_SCHEMA = "name bigint, more int, doc_id bigint, row bigint, tie int, at int"
CUT_SCHEMA = "doc_id bigint, n_chars bigint, n_removed bigint, n_spans bigint, spans array<struct<start:int,stop:int>>, kept string"


def min_hashes(grams: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """`count` MinHash values for each segment; every segment has a gram."""
    out, held = np.empty((count, len(starts) - 1), U64), np.empty_like(grams)
    for k in range(count):
        np.bitwise_xor(grams, salt(2 * k + 500), out=held)
        np.multiply(held, salt(2 * k + 501) | U64(1), out=held)
        np.minimum.reduceat(held, starts[:-1], out=out[k])
    return out.T


def _distinct_grams(grams: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    grams, segment = sort_segments(grams, starts)
    fresh = np.ones(len(grams), bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (segment[1:] != segment[:-1])
    return grams[fresh], np.concatenate([[0], np.cumsum(np.bincount(segment[fresh], minlength=len(starts) - 1))])


def _blocks(row: np.ndarray, sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last but one of the lines of each block: all successive lines of one text that have words,
    but fewer than `least`, if they are several and have `least` together."""
    short = (sizes > 0) & (sizes < least)
    begins = short.copy()
    begins[1:] &= ~short[:-1] | (row[1:] != row[:-1])
    ends = short.copy()
    ends[:-1] &= ~short[1:] | (row[1:] != row[:-1])
    first, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    total = np.concatenate([[0], np.cumsum(sizes)])
    enough = (total[stop] - total[first] >= least) & (stop - first > 1)
    return first[enough], stop[enough]


def _lines(texts: list[str | None]):
    """For runs of texts: where the run begins, and of all its lines the text, the number in it, and the words."""
    for own in text_runs(texts, RUN_CHARS):
        lines = [(t or "").split("\n") for t in texts[own]]
        flat = [line for split in lines for line in split]
        counts = np.array([len(split) for split in lines])
        row = np.repeat(np.arange(own.start, own.stop), counts)
        number = np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)
        yield row, number, *word_hashes(flat)


def _judged(row: np.ndarray, starts: np.ndarray, least: int, blocks: bool) -> tuple[np.ndarray, np.ndarray]:
    """First and last but one of the lines of each paragraph that is banded."""
    sizes = np.diff(starts)
    first = np.flatnonzero(sizes >= max(least, 1))
    stop = first + 1
    if blocks:
        more = _blocks(row, sizes, least)
        first, stop = np.concatenate([first, more[0]]), np.concatenate([stop, more[1]])
    return first, stop


def _segments(words: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words from each `begin` to its `stop`, one after another, and where each run begins."""
    sizes = stop - begin
    ends = np.cumsum(sizes)
    return words[np.repeat(begin - ends + sizes, sizes) + np.arange(ends[-1])], np.concatenate([[0], ends])


def _paragraphs(texts: list[str | None], least: int, blocks: bool):
    """For runs of texts, of all banded paragraphs: grams, where they begin, and the two hashes that name the unit."""
    for row, _, words, starts in _lines(texts):
        first, stop = _judged(row, starts, least, blocks)
        if len(first):
            own, begins = _segments(words, starts[first], starts[stop])
            yield *shingles(own, begins), sequence_names(own, begins)


def _sets(least: int, blocks: bool):
    def run(batches):
        for batch in batches:
            for grams, starts, names in _paragraphs(batch.column("text").to_pylist(), least, blocks):
                grams, starts = _distinct_grams(grams, starts)
                once = np.unique(names[0], return_index=True)[1]
                sizes = np.diff(starts).astype(np.int32)
                sets = gram_sets(grams, starts)
                yield pa.record_batch([
                    unit_names(*(n[once] for n in names)), pa.array(sizes[once]),
                    lists(np.zeros((len(once), 0), U64)), pa.array([sets[i] for i in once], pa.binary()),
                ], ["unit", "n", "bits", "grams"])

    return tidy(run)


def _places(least: int, blocks: bool):
    """Where the banded paragraphs stand, the first of equal ones with its bands, and with `blocks` the
    shorter lines, which are only equal to equal ones."""

    def run(batches):
        for batch in batches:
            for row, number, words, starts in _lines(batch.column("text").to_pylist()):
                first, stop = _judged(row, starts, least, blocks)
                judged = len(first)
                if blocks:
                    sizes = np.diff(starts)
                    lone = np.flatnonzero((sizes >= SHORTEST) & (sizes < least))
                    first, stop = np.concatenate([first, lone]), np.concatenate([stop, lone + 1])
                if not len(first):
                    continue
                own, begins = _segments(words, starts[first], starts[stop])
                names = sequence_names(own, begins)
                banded = np.zeros(len(first), bool)
                banded[np.unique(names[0][:judged], return_index=True)[1]] = True
                keys = np.empty((0, BANDS), U64)
                if judged:
                    grams, held = shingles(own[: begins[judged]], begins[: judged + 1])
                    keys = band_keys(min_hashes(grams, held, ROWS * BANDS), ROWS)[banded[:judged]]
                ends = pa.array(np.concatenate([[0], np.cumsum(np.where(banded, BANDS, 0))]), pa.int32())
                copies = [batch.column(c).take(pa.array(row[first])) for c in ("doc_id", "row", "tie")]
                numbers = [pa.array(x.astype(np.int32)) for x in (number[first], stop - first, np.diff(begins))]
                yield pa.record_batch(
                    [unit_names(*names), *copies, *numbers, pa.ListArray.from_arrays(ends, lists(keys).values)],
                    ["unit", "doc_id", "row", "tie", "paragraph", "lines", "words", "bands"],
                )

    return tidy(run)


def settled_lines(found: list[tuple[int, int, int]], least: int) -> list[int]:
    """The lines that go, of paragraphs given as first line, lines and words: those of each run of
    successive lines that has `least` words together."""
    out, run, words, end = [], [], 0, None
    for first, lines, count in [*sorted(found), (None, 0, 0)]:
        if first is None or (end is not None and first > end):
            out += run if words >= least else []
            run, words = [], 0
        if first is not None:
            run += range(max(first, end or 0), first + lines)
            words += count
            end = max(end or 0, first + lines)
    return out


def _slid(values: np.ndarray, width: int, least_or_most: np.ufunc) -> np.ndarray:
    """The least or most of each `width` values in a row."""
    size = 1
    while size < width:
        step = min(size, width - size)
        values = least_or_most(values[:-step], values[step:])
        size += step
    return values


def chosen_windows(words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The windows that have the least hash of STEP in a row, or of all in a text with fewer windows:
    where they begin in `words`, and their hashes."""
    hashes = runs_of_words(words, WINDOW)
    n = np.maximum(np.diff(starts) - WINDOW + 1, 0)
    whole = np.flatnonzero(n)
    if not len(whole):
        return np.zeros(0, int), hashes[:0]
    n, ends = n[whole], np.cumsum(n[whole])
    first = ends - n
    at = np.repeat(starts[:-1][whole] - first, n) + np.arange(ends[-1])
    hashes = hashes[at]
    # Of each run of STEP windows in one text its least hash; a run that leaves the text has none.
    least = np.full(len(hashes), ~U64(0))
    if len(hashes) >= STEP:
        least[: len(hashes) - STEP + 1] = _slid(hashes, STEP, np.minimum)
    number = np.arange(len(hashes)) - np.repeat(first, n)
    least[np.repeat(n, n) - number < STEP] = 0
    # A window is chosen if it is the least of any run that it is in; runs that begin in the text before have none.
    here = _slid(np.concatenate([np.zeros(STEP - 1, U64), least]), STEP, np.maximum)
    short = np.repeat(n < STEP, n)
    here[short] = np.repeat(np.minimum.reduceat(hashes, first), n)[short]
    chosen = np.flatnonzero(hashes == here)
    return at[chosen], hashes[chosen]


def _windows(batches):
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for own in text_runs(texts, RUN_CHARS):
            words, starts = word_hashes(texts[own])
            at, names = chosen_windows(words, starts)
            more = (runs_of_words(mix(words ^ salt(900)), WINDOW)[at] >> U64(32)).astype(np.uint32).view(np.int32)
            text = np.searchsorted(starts, at, "right") - 1
            keys = [batch.column(c).take(pa.array(text + own.start)) for c in ("doc_id", "row", "tie")]
            yield pa.record_batch(
                [pa.array(names.view(np.int64)), pa.array(more), *keys, pa.array((at - starts[text]).astype(np.int32))],
                ["name", "more", "doc_id", "row", "tie", "at"],
            )
    release()


def passage_spans(text: str, passages: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words as places in the text, with the blanks after each; those that touch are one."""
    begins, ends = word_places(text)
    out = []
    for start, stop in sorted(passages):
        a, b = int(begins[start]), int(ends[stop - 1])
        while b < len(text) and text[b] == " ":
            b += 1
        # What stands between two passages without a word between them goes with them.
        if out and start <= last:
            out[-1] = (out[-1][0], max(out[-1][1], b))
            last = max(last, stop)
        else:
            out.append((a, b))
            last = stop
    return out


def cut_passages(text: str, removed: list[int], passages: list[tuple[int, int]]) -> tuple[str, list[dict[str, int]]]:
    """The text without the lines `removed` and the runs of words `passages`, and the places of what went."""
    kept, spans = cut_paragraphs(text, removed)
    if not passages:
        return kept, spans
    cuts = passage_spans(text, passages)
    gone = np.zeros(len(text), bool)
    for a, b in cuts:
        gone[a:b] = True
    whole, left, at, end = set(removed), [], 0, None
    for i, line in enumerate(text.split("\n")):
        if i not in whole:
            # Lines are joined where one passage reaches from the first into the second.
            if end is not None and not (gone[end] and gone[at - 1]):
                left.append("\n")
            stays = ~gone[at : at + len(line)]
            edges = np.flatnonzero(np.diff(stays, prepend=False, append=False)).tolist()
            left.append("".join(line[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            end = at + len(line)
        at += len(line) + 1
    kept = "".join(left)
    joined = []
    for a, b in sorted([*cuts, *((s["start"], s["stop"]) for s in spans)]):
        if joined and a <= joined[-1]["stop"]:
            joined[-1]["stop"] = max(joined[-1]["stop"], b)
        else:
            joined.append({"start": a, "stop": b})
    return kept, joined


def cut_paragraphs(text: str, removed: list[int]) -> tuple[str, list[dict[str, int]]]:
    """The text without the paragraphs `removed`, and the runs of them as places in the text."""
    gone, kept, spans, at = set(removed), [], [], 0
    for i, line in enumerate(text.split("\n")):
        if i not in gone:
            kept.append(line)
        elif i - 1 in gone:
            spans[-1]["stop"] = at + len(line)
        else:
            spans.append({"start": at, "stop": at + len(line)})
        at += len(line) + 1
    return "\n".join(kept), spans


def _cut_batch(texts: pa.Array, removed: pa.Array, passages: pa.Array, least: int):
    """Of each text what stays, and the places of what goes."""
    for text, lines, spans in zip(texts.to_pylist(), removed.to_pylist(), passages.to_pylist(), strict=True):
        if not lines and not spans:
            yield text, text or "", []
            continue
        gone = settled_lines([(p["paragraph"], p["lines"], p["words"]) for p in lines or []], least)
        yield text, *cut_passages(text or "", gone, [(p["start"], p["stop"]) for p in spans or []])


def _cut(least: int):
    def run(batches):
        for batch in batches:
            columns = [batch.column(c) for c in ("text", "removed", "passages")]
            out = [
                (len(text or ""), len(text or "") - len(kept), len(spans), spans, kept if text is not None else None)
                for text, kept, spans in _cut_batch(*columns, least)
            ]
            columns = list(zip(*out, strict=True)) or [()] * 5
            span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
            yield pa.record_batch([
                batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:3]),
                pa.array(columns[3], span), pa.array(columns[4], pa.string()),
            ], ["doc_id", "n_chars", "n_removed", "n_spans", "spans", "kept"])

    return tidy(run)


def repeated_paragraphs(docs: DataFrame, threshold: float = 0.8, min_words: int = LEAST_WORDS, blocks: bool = False) -> DataFrame:
    """`row, tie, removed`: the paragraphs that stand elsewhere earlier, as first line, lines and words, for
    each document that has any. With `blocks`, blocks and shorter lines are among them."""
    source = keyed(docs)
    noted, path = written(source.mapInArrow(_places(min_words, blocks), PLACE_SCHEMA), "places")
    banded = noted.where("size(bands) > 0")
    buckets = shared_buckets(banded.select("unit", "bands"))
    candidates = buckets.select("unit").distinct()
    # One document for each candidate gives its set.
    picked = banded.groupBy("unit").agg(F.min(F.struct("row", "tie")).alias("one")).join(candidates, "unit", "left_semi")
    chosen = source.join(picked.select("one.*").distinct(), ["row", "tie"], "left_semi").mapInArrow(_sets(min_words, blocks), SET_SCHEMA)
    sets = chosen.join(candidates, "unit", "left_semi").dropDuplicates(["unit"])
    roots = group_units(buckets, stored(sets, "paragraph_sets"), threshold)
    order = F.struct(F.col("doc_id").isNotNull(), "doc_id", "tie", "row", "paragraph", "lines")
    places = noted.drop("bands").join(roots, "unit", "left")
    places = stored(places.withColumn("root", F.coalesce("root", "unit")).drop("unit"), "paragraphs").withColumn("at", order)
    remove_path(docs.sparkSession, path)
    # The first of each component, by aggregation; the others find it by their root.
    first = places.groupBy(F.struct("root").alias("key")).agg(F.min("at").alias("first"), F.max("at").alias("last"))
    first = first.where("first < last").select("key.root", "first")
    later = places.join(first, "root").where("at > first")
    return later.groupBy("row", "tie").agg(F.collect_set(F.struct("paragraph", "lines", "words")).alias("removed"))


def repeated_passages(docs: DataFrame) -> DataFrame:
    """`row, tie, passages`: the runs of words that go from a document, if any do.

    A window goes if an equal one stands earlier, in the order of `remove_paragraphs`; windows that
    overlap the first of their kind go only as far as it does not reach.
    """
    windows, path = written(keyed(docs).mapInArrow(_windows, WINDOW_SCHEMA), "windows")
    # Which windows repeat is found over short hashes; only those are sent with their places. Keys
    # are grouped as structs, so that a join shuffles both sides and splits a hot one.
    place = F.xxhash64("row", "tie", "at")
    several = windows.groupBy(F.struct("name").alias("key")).agg(F.min(place).alias("low"), F.max(place).alias("high"))
    order = F.struct(F.col("doc_id").isNotNull(), "doc_id", "tie", "row", F.col("at").alias("start"))
    found = windows.join(several.where("low < high").select("key.name"), "name", "left_semi")
    found = stored(found, "passages").withColumn("place", order).drop("doc_id")
    remove_path(docs.sparkSession, path)
    first = found.groupBy(F.struct("name", "more").alias("key")).agg(F.min("place").alias("first"), F.max("place").alias("last"))
    first = first.where("first < last").select("key.*", "first")
    later = found.join(first, ["name", "more"]).where("place > first")
    clear = F.when((F.col("first.row") == F.col("row")) & (F.col("first.tie") == F.col("tie")), F.col("first.start") + WINDOW).otherwise(0)
    span = F.struct(F.greatest("at", clear).alias("start"), (F.col("at") + WINDOW).alias("stop"))
    later = later.select("row", "tie", span.alias("span")).where("span.start < span.stop")
    return later.groupBy("row", "tie").agg(F.collect_set("span").alias("passages"))


def _repeated(docs: DataFrame, threshold: float, min_words: int) -> DataFrame:
    """`row, tie, removed, passages` of documents that lose anything."""
    if threshold < 0.8:
        raise ValueError("the bands are made for similarities of 0.8 or more")
    return repeated_paragraphs(docs, threshold, min_words, blocks=True).join(repeated_passages(docs), ["row", "tie"], "full")


def remove_paragraphs(docs: DataFrame, threshold: float = 0.8, min_words: int = LEAST_WORDS) -> DataFrame:
    """`doc_id, n_chars, n_removed, n_spans, spans, kept` for every row of `docs` (`doc_id, text`).

    Paragraphs are lines; those with at least `min_words` words (runs of letters and digits) are
    linked if the sets of their five-word shingles have a Jaccard similarity of at least `threshold` (0.8
    or more). Of each connected component the first paragraph stays: by document id, a null id first,
    then by hashes of the text, then by place. `spans` are the runs of removed paragraphs as places in
    the text, `kept` the other paragraphs, and `n_removed` the characters that `kept` is shorter. Rows that repeat
    id and text are one document, with a row each. A null text has no paragraphs and stays null. Other
    columns are not read.
    """
    if threshold < 0.8:
        raise ValueError("the bands are made for similarities of 0.8 or more")
    removed = repeated_paragraphs(docs, threshold, min_words)
    none = F.lit(None).cast("array<struct<start:int,stop:int>>").alias("passages")
    whole = keyed(docs).join(removed, ["row", "tie"], "left").select("doc_id", "text", "removed", none)
    return whole.mapInArrow(_cut(min_words), CUT_SCHEMA)


def remove_passages(docs: DataFrame, threshold: float = 0.8, min_words: int = LEAST_WORDS) -> DataFrame:
    """As `remove_paragraphs`, with blocks of shorter lines as paragraphs, and without the passages that
    repeat inside or across lines.

    A block is all successive lines that have words, but fewer than `min_words`, if they have as many
    together. Lines of SHORTEST words and more that equal an earlier line go where the successive lines
    that go have `min_words` words together. Of a run of WINDOW + STEP - 1 words or more that stands
    earlier in any document, all goes but at most STEP - 1 words at either end; of shorter ones those
    of WINDOW words and more that hold a chosen window. Words are compared without case and what stands
    between them.
    """
    whole = keyed(docs).join(_repeated(docs, threshold, min_words), ["row", "tie"], "left")
    return whole.select("doc_id", "text", "removed", "passages").mapInArrow(_cut(min_words), CUT_SCHEMA)


def trim_documents(docs: DataFrame, threshold: float = 0.8, min_words: int = LEAST_WORDS) -> DataFrame:
    """All columns of `docs`, with `text` cut as by `remove_passages` and, where there is the column,
    `n_chars` counted again. A document whose text is cut to nothing but blanks goes."""
    joined, names = with_found(docs, _repeated(docs, threshold, min_words))
    removed, passages = names["removed"], names["passages"]

    @F.arrow_udf("string")
    def kept(texts: pa.Array, lines: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array([None if t is None else k for t, k, _ in _cut_batch(texts, lines, spans, min_words)], pa.string())

    whole = F.col(removed).isNull() & F.col(passages).isNull()
    cut = kept.asNondeterministic()("text", removed, passages)  # so that what looks at the text does not cut it again
    joined = joined.withColumn("text", F.when(whole, F.col("text")).otherwise(cut))
    joined = joined.where(whole | F.col("text").rlike(r"\S"))
    if "n_chars" in docs.columns:
        count = F.when(whole, F.col("n_chars")).otherwise(F.length("text"))
        joined = joined.withColumn("n_chars", count.cast(docs.schema["n_chars"].dataType))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns])
