"""Byte-level BPE over a table of distinct words.

Texts are split into words where the vocabulary's own rule splits them. Each distinct word is
encoded once for some hundred parts of the corpus (a part is a bounded run of documents), and its ids are
joined back to every place where it stands. Within a part a word crosses the network once, however
often it occurs, and a bucket of the word table holds words of a bounded number of parts, however
many parts have them.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quotelake.llm.shared import release, text_runs, tidy

# Spark runs one task on each core; threads of the library's own would only take memory.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Fixed value: where byte-level vocabularies split a text before any merge.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

# The same for texts of plain ASCII and accented Latin letters, where the faster engine agrees.
SIMPLE_WORDS = re.compile(
    r" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+|'(?:[stmd]|re|ve|ll)| ?[0-9]+"
    r"| ?[^\sA-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+|\s+(?!\S)|\s+"
)
BEYOND_SIMPLE = re.compile(r"[^\t\n\r\x20-\x7e\u00c0-\u024f]")
BEYOND_LATIN = regex.compile(r"[^\x00-\u024f]")

WORD_SCHEMA = "part bigint, span bigint, bucket int, slots binary, lengths binary, words binary"
WORD_TYPES = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
CODE_SCHEMA = "part bigint, words int, doc_ids array<bigint>, sizes array<int>, codes binary"
ID_SCHEMA = "part bigint, slots binary, counts binary, ids binary"
TOKEN_SCHEMA = "doc_id bigint, n_tokens bigint, ids binary, decoded string"

ROW_CHARS = 1 << 20  # characters of the documents that share a row
#: Parts that share word buckets: as many of one partition of the input, of so many partitions in a row.
SPAN_PARTS, SPAN_PARTITIONS, BUCKETS = 64, 8, 64
CODEC = pa.Codec("zstd", compression_level=3)
SAME_ORDER = "are the documents read in the same order each time?"


@lru_cache(maxsize=2)
def _tokenizer(vocabulary: str) -> Tokenizer:
    tokenizer = Tokenizer.from_str(vocabulary)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@lru_cache(maxsize=2)
def _specials(vocabulary: str):
    """Finds the added tokens, the longest first; they are words of their own."""
    added = [t.content for t in _tokenizer(vocabulary).get_added_tokens_decoder().values()]
    return regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level piece stands for: printable bytes stand for
    themselves, the others in turn for the letters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def _pieces(vocabulary: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all pieces in a row, and where each id's begin."""
    letters, table = byte_letters(), _tokenizer(vocabulary).get_vocab(with_added_tokens=True)
    pieces = [b""] * (max(table.values()) + 1)
    for piece, i in table.items():
        pieces[i] = bytes(letters[c] for c in piece) if all(c in letters for c in piece) else piece.encode()
    return np.frombuffer(b"".join(pieces), np.uint8), np.cumsum([0, *map(len, pieces)])


@lru_cache(maxsize=1)
def _unsettled():
    """Finds characters that came after Unicode 3.2 or lie outside the first plane. The Unicode
    versions of the two regex engines differ, so only the library itself can class these."""
    new = [chr(c) for c in range(0x250, 0x10000) if unicodedata.ucd_3_2_0.category(chr(c)) == "Cn"]
    changed = [
        chr(c) for c in range(0x250, 0x10000)
        if unicodedata.ucd_3_2_0.category(chr(c))[0] != unicodedata.category(chr(c))[0]
    ]
    return regex.compile(f"[{''.join(map(regex.escape, sorted({*new, *changed})))}\\U00010000-\\U0010FFFF]")


def _plain_words(text: str, tokenizer: Tokenizer) -> list[str]:
    if not BEYOND_SIMPLE.search(text):
        return SIMPLE_WORDS.findall(text)
    if BEYOND_LATIN.search(text) and _unsettled().search(text):
        return [text[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text)]
    return WORDS.findall(text)


def split_words(text: str, vocabulary: str) -> list[str]:
    """The words of `text`; together they are the text."""
    tokenizer, specials = _tokenizer(vocabulary), _specials(vocabulary)
    if specials is None or not specials.search(text):
        return _plain_words(text, tokenizer)
    words, at = [], 0
    for m in specials.finditer(text):
        words += [*_plain_words(text[at : m.start()], tokenizer), m.group()]
        at = m.end()
    return words + _plain_words(text[at:], tokenizer)


def _gather(starts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the entries `which` of a ragged array, one after another, and their lengths."""
    lengths = starts[which + 1] - starts[which]
    ends = np.cumsum(lengths)
    return np.repeat(starts[which] - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0), lengths


def _parts(batches: Iterator[pa.RecordBatch], part_chars: int):
    """The task's documents in parts: number, ids, texts. The numbers hold the task's place in the scan."""
    number, ids, texts, size = (TaskContext.get().partitionId() << 32), [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            text = text or ""
            if texts and size + len(text) > part_chars:
                yield number, ids, texts
                number, ids, texts, size = number + 1, [], [], 0
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
    if texts:
        yield number, ids, texts


def _pack(numbers: np.ndarray) -> bytes:
    """32-bit integers, compressed; bytes of one weight stand together, as the high ones are mostly zero."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()
    return len(numbers).to_bytes(4, "little") + CODEC.compress(planes, asbytes=True)


def _unpack(packed: bytes) -> np.ndarray:
    n = int.from_bytes(packed[:4], "little")
    planes = np.frombuffer(CODEC.decompress(packed[4:], 4 * n, asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel()


def _pack_words(raw: list[bytes]) -> tuple[bytes, bytes]:
    text = b"".join(raw)
    return _pack(np.fromiter(map(len, raw), np.int64, len(raw))), len(text).to_bytes(4, "little") + CODEC.compress(text, asbytes=True)


def _unpack_words(lengths: bytes, text: bytes) -> list[str]:
    raw = CODEC.decompress(text[4:], int.from_bytes(text[:4], "little"), asbytes=True)
    ends = np.cumsum(_unpack(lengths).astype(np.int64)).tolist()
    return [raw[a:b].decode() for a, b in zip([0, *ends], ends, strict=False)]


def _byte_classes() -> np.ndarray:
    """Of each byte of a simple text: 0 white space, 1 letter, 2 digit, 3 anything else. The bytes of a
    letter of two bytes are letters; the two signs among these letters are seen to by `_simple_starts`."""
    classes = np.full(256, 3, np.uint8)
    classes[[9, 10, 13, 32]] = 0
    classes[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
    classes[48:58] = 2
    return classes


BYTE_CLASSES = _byte_classes()
#: The two signs, as pairs of bytes, and the two letters of the longer contractions.
SIGNS, ENDINGS = (0xC397, 0xC3B7), [int.from_bytes(e, "big") for e in (b"re", b"ve", b"ll")]


def _simple_starts(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the words of simple texts begin, as SIMPLE_WORDS finds them, in the bytes of all texts; no word
    crosses one of `bounds`, where the texts begin."""
    n, classes = len(raw), BYTE_CLASSES[raw]
    pairs = (raw[:-1].astype(np.uint16) << 8) | raw[1:]
    for at in np.flatnonzero((pairs == SIGNS[0]) | (pairs == SIGNS[1])):
        classes[at : at + 2] = 3
    first = np.zeros(n + 1, bool)
    first[bounds] = True
    starts = first[:n].copy()
    starts[1:] |= classes[1:] != classes[:-1]
    # The last white space before a word: a blank belongs to the word, any other is a word of its own.
    last = np.flatnonzero((classes[:-1] == 0) & (classes[1:] != 0) & ~first[1:n])
    starts[last] = True
    starts[last[raw[last] == 32] + 1] = False
    # A contraction begins with an apostrophe that begins a word, and what follows it is a new word.
    mark = np.flatnonzero((raw[:-1] == 39) & starts[:-1] & ~first[1:n])
    one = mark[np.isin(raw[mark + 1], np.frombuffer(b"stmd", np.uint8))]
    mark = mark[mark + 2 < n]
    two = mark[np.isin(pairs[mark + 1], ENDINGS) & ~first[mark + 2]]
    for held, width in ((one, 2), (two, 3)):
        starts[held + 1] = False
        starts[(held + width)[held + width < n]] = True
    return np.flatnonzero(starts)


def _words(texts: list[str], vocabulary: str) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of `texts` as they first come, all words as their numbers, and how many each text has."""
    specials = _specials(vocabulary)
    places = [np.zeros(0, np.int64)]
    simple = [not BEYOND_SIMPLE.search(t) and not (specials and specials.search(t)) for t in texts]
    raw = [t.encode() for t in texts]
    starts_at = np.cumsum([0, *map(len, raw)])
    every = np.frombuffer(b"".join(raw), np.uint8)
    i = 0
    while i < len(texts):
        j = i + 1
        if simple[i]:
            while j < len(texts) and simple[j]:
                j += 1
            a, b = starts_at[i], starts_at[j]
            if b > a:
                places.append(a + _simple_starts(every[a:b], starts_at[i : j + 1] - a))
        else:
            lengths = [len(w.encode()) for w in split_words(texts[i], vocabulary)]
            places.append(starts_at[i] + np.cumsum([0, *lengths[:-1]]) if lengths else places[0])
        i = j
    places = np.concatenate(places)
    sizes = np.diff(np.searchsorted(places, starts_at))
    offsets = np.append(places, len(every))
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(places), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(every)]
    ).dictionary_encode()
    return words.dictionary, words.indices.to_numpy(), sizes


def _part_words(vocabulary, part_chars: int, buckets: int):
    """The distinct words of each part, dealt into buckets by their hash."""

    def run(batches):
        for number, _, texts in _parts(batches, part_chars):
            words = _words(texts, vocabulary.value)[0].to_pylist()
            bucket = np.fromiter((crc32(w) for w in words), np.int64, len(words)) % buckets
            order = np.argsort(bucket, kind="stable")
            span = (number >> 32) // SPAN_PARTITIONS << 32 | (number & 0xFFFFFFFF) // SPAN_PARTS
            rows = []
            for own in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []:
                rows.append((number, span, int(bucket[own[0]]), _pack(own), *_pack_words([words[i] for i in own])))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), WORD_TYPES, strict=True)],
                    ["part", "span", "bucket", "slots", "lengths", "words"],
                )

    return tidy(run)


def _part_codes(vocabulary, part_chars: int):
    """The documents of each part as the numbers of their words, some documents in a row."""

    def run(batches):
        for number, ids, texts in _parts(batches, part_chars):
            distinct, codes, counts = _words(texts, vocabulary.value)
            ends = np.concatenate([[0], np.cumsum(counts)])
            for own in text_runs(texts, ROW_CHARS):
                sizes = counts[own].tolist()
                yield pa.RecordBatch.from_arrays([
                    pa.array([number], pa.int64()), pa.array([len(distinct)], pa.int32()),
                    pa.array([ids[own]], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int32())),
                    pa.array([_pack(codes[ends[own.start] : ends[own.stop]])], pa.binary()),
                ], ["part", "words", "doc_ids", "sizes", "codes"])

    return tidy(run)


def _encode_bucket(vocabulary):
    """One bucket of the word table: each distinct word is encoded once, for all parts of the span that hold it."""

    def run(rows: pa.Table) -> pa.Table:
        held = [_unpack_words(a, b) for a, b in zip(rows["lengths"].to_pylist(), rows["words"].to_pylist(), strict=True)]
        table = {w: i for i, w in enumerate(dict.fromkeys(w for words in held for w in words))}
        distinct, tokenizer = list(table), _tokenizer(vocabulary.value)
        ids = []
        for i in range(0, len(distinct), 5_000):  # what the library returns takes far more room than the ids
            ids += [e.ids for e in tokenizer.encode_batch_fast(distinct[i : i + 5_000], add_special_tokens=False)]
        starts = np.cumsum([0, *map(len, ids)])
        flat = np.fromiter((i for own in ids for i in own), np.int64, starts[-1])
        counts, found = [], []
        for words in held:
            at, lengths = _gather(starts, np.fromiter(map(table.__getitem__, words), np.int64, len(words)))
            counts.append(_pack(lengths))
            found.append(_pack(flat[at]))
        return pa.table(
            [rows["part"], rows["slots"], pa.array(counts, pa.binary()), pa.array(found, pa.binary())],
            ["part", "slots", "counts", "ids"],
        )

    return run


def _join_back(vocabulary):
    """One part: the ids of each document from those of its words, and its text from the ids."""

    def run(rows: pa.Table, words: pa.Table) -> pa.Table:
        if not rows.num_rows:
            raise RuntimeError(f"words without documents; {SAME_ORDER}")
        piece_bytes, piece_starts = _pieces(vocabulary.value)
        slots, counts, ids = (
            np.concatenate([np.zeros(0, np.int64), *(_unpack(x).astype(np.int64) for x in words[c].to_pylist())])
            for c in ("slots", "counts", "ids")
        )
        if len(slots) != rows["words"][0].as_py():
            raise RuntimeError(f"{rows['words'][0].as_py()} words expected, {len(slots)} found; {SAME_ORDER}")
        # From the order of the buckets to that of the slots.
        ends = np.cumsum(counts)
        place = np.empty(len(slots), np.int64)
        place[slots] = np.arange(len(slots))
        starts = np.concatenate([[0], ends])
        at, counts = _gather(starts, place)
        ids, starts = ids[at], np.concatenate([[0], np.cumsum(counts)])
        doc_ids, out, texts = [], [], []
        for own_ids, sizes, packed in zip(*(rows[c].to_pylist() for c in ("doc_ids", "sizes", "codes")), strict=True):
            at, lengths = _gather(starts, _unpack(packed).astype(np.int64))
            tokens = ids[at]
            spelled, widths = _gather(piece_starts, tokens)
            text = piece_bytes[spelled].tobytes()
            word_ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum([0, *sizes])]
            byte_ends = np.concatenate([[0], np.cumsum(widths)])[word_ends]
            raw = tokens.astype("<u4").tobytes()
            doc_ids += own_ids
            out += [raw[4 * a : 4 * b] for a, b in zip(word_ends[:-1], word_ends[1:], strict=True)]
            texts += [text[a:b].decode("utf-8", "replace") for a, b in zip(byte_ends[:-1], byte_ends[1:], strict=True)]
        made = pa.table([
            pa.array(doc_ids, pa.int64()), pa.array([len(x) // 4 for x in out], pa.int64()),
            pa.array(out, pa.binary()), pa.array(texts, pa.string()),
        ], ["doc_id", "n_tokens", "ids", "decoded"])
        del rows, words, ids, texts, out
        release()
        return made

    return run


def encode_documents(docs: DataFrame, vocabulary_path: str, part_chars: int = 1 << 22, buckets: int | None = None) -> DataFrame:
    """`doc_id, n_tokens, ids, decoded` for every row of `docs` (`doc_id, text`).

    `ids` are what the tokenizers library gives for the whole text without adding special tokens, as
    little-endian unsigned 32-bit integers; `decoded` is the text that the ids stand for. Rows
    stay apart when they repeat or share an id; a null text counts as empty and an empty one has no
    ids. Other columns are not read. `part_chars` bounds what one task holds (a longer document is a
    part of its own); the words of up to SPAN_PARTS times SPAN_PARTITIONS parts are dealt into `buckets`
    buckets (BUCKETS of them by default). The vocabulary is read by the driver; it must be byte-level BPE.

    The documents are read twice, and each part must come out the same both times, as it does from a
    stored table; write other plans to a table first. A mismatch ends the job with an error.
    """
    with open(vocabulary_path, encoding="utf-8") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    words = source.mapInArrow(_part_words(vocabulary, part_chars, buckets or BUCKETS), WORD_SCHEMA)
    ids = words.groupBy("span", "bucket").applyInArrow(_encode_bucket(vocabulary), ID_SCHEMA)
    codes = source.mapInArrow(_part_codes(vocabulary, part_chars), CODE_SCHEMA)
    return codes.groupBy("part").cogroup(ids.groupBy("part")).applyInArrow(_join_back(vocabulary), TOKEN_SCHEMA)
