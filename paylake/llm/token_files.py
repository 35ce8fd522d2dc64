"""Token ids in files of Simple-8b words, written and read by Spark tasks.

An id stream is cut into blocks of ``BLOCK`` ids. In a block a 64-bit word holds a
selector in its top four bits and as many ids as fit into the other sixty, all of the
selector's width. Selector 0 is the escape: the next word is one whole id of more
than sixty bits. Blocks stand on word boundaries, and their offsets in the file's
footer let a reader decode any of them, or many at once, without those before.

A file: the blocks; then the footer's arrays (block offsets in words, document ids,
whether a document has an id, ids in each document); then the numbers of blocks, words,
documents and ids; then the magic. All numbers are little-endian.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paylake.llm.bpe import WORD_BPE, load
from paylake.llm.common import binaries, bounded_batches, partitions, pick, steps, stored
from paylake.session import scratch_dir

BLOCK = 1024

#: Characters of text that a task cuts into words at once: in more text more words repeat.
CHARS_AT_ONCE = 1 << 22

#: Blocks that a task encodes or decodes at once.
BLOCKS_AT_ONCE = 256

MAGIC = b"SIMPLE8B"

ESCAPE = 0

#: Ids in a word and bits of each, by selector - 1: the fixed values of the coding.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTHS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)

#: The same by selector; an escape takes one id.
TAKEN = np.concatenate(([1], COUNTS))
BITS = np.concatenate(([0], WIDTHS)).astype(np.uint64)


def encode_words(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """The words of an id stream, and the words in each block."""
    ids = ids.astype(np.uint64)
    n = len(ids)
    need = np.zeros(-(-n // block) * block, np.uint8)
    need[n:] = 255
    highest = int(ids.max(initial=0))
    plain = ids.astype(np.uint32) if highest < 1 << 32 else ids
    for width in WIDTHS[WIDTHS < highest.bit_length()].tolist():
        # The number of widths too narrow for an id.
        need[:n] += plain >= plain.dtype.type(1 << width)
    # A block in a row; what stands past its end fits no width.
    most = {1: np.pad(need.reshape(-1, block), ((0, 0), (0, int(COUNTS[0]))), constant_values=255)}
    selector = np.full((len(need) // block, block), ESCAPE, np.uint8)
    # From the fewest to the most ids in a word: the last that fits stays.
    for number in range(len(COUNTS), 0, -1):
        count = int(COUNTS[number - 1])
        if count not in most:
            # The most of so many ids from here on, by that of fewer ones, which overlap.
            fewer = max(c for c in most if c < count)
            while 2 * fewer < count:
                most[2 * fewer] = np.maximum(most[fewer][:, :-fewer], most[fewer][:, fewer:])
                fewer *= 2
            most[count] = np.maximum(most[fewer][:, : fewer - count], most[fewer][:, count - fewer :])
        selector[most[count][:, :block] < number] = number
    selector = selector.ravel()[:n]
    taken = TAKEN[selector]
    # Follow the words of all blocks side by side.
    begins = np.zeros(n, bool)
    here = np.arange(0, n, block)
    ends = np.minimum(here + block, n)
    while len(here):
        begins[here] = True
        here = here + taken[here]
        left = here < ends
        if not left.all():
            here, ends = here[left], ends[left]
    first = np.flatnonzero(begins)
    chosen = selector[first].astype(np.uint64)
    escaped = chosen == ESCAPE
    words = chosen << np.uint64(60)
    # The first id of every word, then the second of those that have one, and so on.
    going = np.flatnonzero(~escaped)
    counts, widths = TAKEN[selector[first]], BITS[selector[first]]
    for j in range(int(COUNTS[0])):
        going = going[counts[going] > j]
        if not len(going):
            break
        words[going] |= ids[first[going] + j] << widths[going] * np.uint64(j)
    per_block = np.bincount(first // block, minlength=-(-n // block))
    if escaped.any():
        where = np.flatnonzero(escaped)
        per_block += np.bincount(first[where] // block, minlength=len(per_block))
        words = np.insert(words, where + 1, ids[first[where]])
    return words, per_block


def decode_words(words: np.ndarray) -> np.ndarray:
    """The ids of whole blocks."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    # A whole id has more than sixty bits, so no selector 0 of its own: what follows one is whole.
    whole = np.concatenate(([False], selector[:-1] == ESCAPE)) if len(words) else np.zeros(0, bool)
    counts = np.where(whole, 1, np.where(selector == ESCAPE, 0, COUNTS[np.minimum(selector, len(COUNTS)) - 1]))
    if ((selector > len(COUNTS)) & ~whole).any():
        raise ValueError("the words are damaged")
    width = np.where(whole, 0, WIDTHS[np.minimum(selector, len(COUNTS)) - 1])
    owner = np.repeat(np.arange(len(words)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    bits = width[owner]
    mask = (np.uint64(1) << bits.astype(np.uint64)) - np.uint64(1)
    ids = words[owner] >> (place * bits).astype(np.uint64) & mask
    return np.where(whole[owner], words[owner], ids)


def _files(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(folder.replace("s3a://", "s3://"))


class _Writer:
    """One file, its blocks written as they fill."""

    def __init__(self, files: pa.fs.FileSystem, path: str):
        self.out = files.open_output_stream(path)
        self.rest: list[np.ndarray] = []
        self.waiting = self.ids = self.words = 0
        self.blocks: list[np.ndarray] = []
        self.docs: list[np.ndarray] = []
        self.known: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, docs: np.ndarray, known: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append(docs)
        self.known.append(known)
        self.counts.append(counts)
        self.rest.append(ids)
        self.waiting += len(ids)
        if self.waiting >= BLOCK * BLOCKS_AT_ONCE:
            self._flush(self.waiting - self.waiting % BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate([*self.rest, np.zeros(0, np.uint32)])
        for a in range(0, n, BLOCK * BLOCKS_AT_ONCE):
            words, per_block = encode_words(ids[a : min(n, a + BLOCK * BLOCKS_AT_ONCE)])
            self.out.write(words.astype("<u8").tobytes())
            self.blocks.append(self.words + np.cumsum(per_block) - per_block)
            self.words += len(words)
        self.rest, self.waiting = [ids[n:]], len(ids) - n
        self.ids += n

    def close(self) -> tuple[int, int]:
        self._flush(self.waiting)
        arrays = [np.concatenate([*x, np.zeros(0, np.int64)]) for x in (self.blocks, self.docs, self.known, self.counts)]
        for array in arrays:
            self.out.write(array.astype("<i8").tobytes())
        sizes = np.array([len(arrays[0]), self.words, len(arrays[1]), self.ids], "<i8")
        self.out.write(sizes.tobytes() + MAGIC)
        self.out.close()
        return len(arrays[1]), self.ids


def write(docs: DataFrame, folder: str, path: str = WORD_BPE, end_id: int | None = 1, id_col: str = "doc_id") -> DataFrame:
    """Writes the ids of all documents to files, in ascending order of ``id_col``.

    Documents are dealt out by ranges of their ids and sorted inside each range; a task
    writes one file. The result, a row for each file (``part``, ``file``, ``n_docs``,
    ``n_tokens``, ``first_token``), is the list of the files that count: a task that
    is run again writes a file of another name, and that of the lost one is never read.
    Null texts are empty; documents without an id come first; of equal ids the order is
    by text.
    """
    rows = pick(docs, id_col, "text").toDF("id", "text")
    ordered = rows.repartitionByRange(partitions(docs), "id").sortWithinPartitions("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        part = TaskContext.get().partitionId()
        files, base = _files(folder)
        files.create_dir(base, recursive=True)
        name = f"part-{part:06d}-{uuid.uuid4().hex}.s8b"
        writer = None
        for batch in batches:
            if batch.num_rows and writer is None:
                writer = _Writer(files, f"{base}/{name}")
            texts = batch.column("text").to_pylist()
            for a, b in steps(texts, CHARS_AT_ONCE):
                ids, counts = bpe.encode(texts[a:b])
                if end_id is not None:
                    ids = np.insert(ids, np.cumsum(counts), end_id)
                    counts = counts + 1
                own = batch.column("id").slice(a, b - a)
                known = np.asarray(own.is_valid().to_numpy(zero_copy_only=False), np.int64)
                writer.add(own.fill_null(0).to_numpy(zero_copy_only=False), known, counts, ids)
        if writer is not None:
            n_docs, n_ids = writer.close()
            yield pa.RecordBatch.from_pydict(
                {"part": [part], "file": [f"{folder.rstrip('/')}/{name}"], "n_docs": [n_docs], "n_tokens": [n_ids]}
            )

    listed = stored(bounded_batches(ordered).mapInArrow(run, "part long, file string, n_docs long, n_tokens long"), "token-files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each file, so this list is short.
    return listed.withColumn("first_token", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read(listed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents of the listed files: id, ``start`` (ids before it in all files), ``n_tokens``, ``ids``.

    A task reads a file a few blocks at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, path = _files(row["file"])
                with files.open_input_file(path) as f:
                    yield from _documents(f, row["first_token"], id_col)

    spread = listed.select("file", "first_token").repartition(partitions(listed))
    return spread.mapInArrow(run, f"`{id_col}` long, start long, n_tokens long, ids binary")


def _documents(f, first: int, id_col: str) -> Iterator[pa.RecordBatch]:
    size = f.size()
    f.seek(size - 40)
    tail = f.read(40)
    if tail[32:] != MAGIC:
        raise ValueError("not a token file")
    n_blocks, n_words, n_docs, n_ids = np.frombuffer(tail[:32], "<i8").tolist()
    f.seek(n_words * 8)
    footer = np.frombuffer(f.read((n_blocks + 3 * n_docs) * 8), "<i8")
    blocks, docs, known, counts = np.split(footer, [n_blocks, n_blocks + n_docs, n_blocks + 2 * n_docs])
    edges = np.concatenate((blocks, [n_words]))
    ends = np.cumsum(counts)
    done, rest = 0, np.zeros(0, np.uint32)
    for a in range(0, max(n_blocks, 1), BLOCKS_AT_ONCE):
        b = min(a + BLOCKS_AT_ONCE, n_blocks)
        f.seek(int(edges[a]) * 8)
        got = decode_words(np.frombuffer(f.read(int(edges[b] - edges[a]) * 8), "<u8"))
        rest = np.concatenate((rest, got.astype("<u4")))
        # Whole documents go out; the rest waits for the next blocks.
        have = (0 if done == 0 else int(ends[done - 1])) + len(rest)
        upto = int(np.searchsorted(ends, have, side="right"))
        taken = counts[done:upto]
        used = int(taken.sum())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(docs[done:upto], mask=known[done:upto] == 0),
                pa.array(first + ends[done:upto] - taken),
                pa.array(taken),
                binaries(rest[:used], taken, 4),
            ],
            names=[id_col, "start", "n_tokens", "ids"],
        )
        done, rest = upto, rest[used:]
    if done != n_docs or int(ends[-1]) != n_ids if n_docs else len(rest):
        raise ValueError("the file is damaged")


def token_folder(df: DataFrame) -> str:
    """A new folder for token files in the shared scratch folder."""
    return os.path.join(scratch_dir(df.sparkSession, "tokens"), "files")
