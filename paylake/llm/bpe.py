"""Byte-pair encoding of words in batched numpy rounds, and decoding.

A vocabulary file of the tokenizers library (word-end BPE over bytes, lower case)
is read as it is. Texts are cut into words on their bytes, by numpy, and each distinct word
of many texts is looked up once. New words are encoded together: their symbols stand in
one flat array, the ranks of neighbouring pairs are looked up in a hash table, and in
every round each word merges its lowest-ranked pair.

Defined results: a null text counts as empty and has no ids; a text that holds a
special token as plain text gives that token's id, as the library does. Rows are
handled one by one, so repeated rows give repeated results.
"""

from __future__ import annotations

import copy
import itertools
import json
import re
import unicodedata
from collections import defaultdict
from collections.abc import Sequence
from functools import cached_property, lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from paylake.llm.common import binaries, map_texts

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

#: Distinct words whose ids a task remembers before it starts afresh, and as many words of odd chunks.
REMEMBERED_WORDS = 200_000

#: Below this code point composition changes nothing and the library's classes are the
#: plain Unicode categories; texts beyond it are split by the library's own parts.
PLAIN_BELOW = 0x180

#: Kinds of bytes. Chunks with odd ones, or with what may be a special token, go to the library's rules whole.
SPACE, LETTER, NUMBER, OTHER, ODD = range(5)
SPACES = b"\t\n\v\f\r "


def _kind(byte: int) -> int:
    if byte in SPACES:
        return SPACE
    if byte >= 0x80:
        # U+00C0 to U+00FF, which start with 0xC3, are letters, but for the signs for times and divided by.
        return LETTER if byte == 0xC3 or byte < 0xC0 and byte not in (0x97, 0xB7) else ODD
    return LETTER if chr(byte).isalpha() else NUMBER if chr(byte).isdigit() else OTHER if byte else ODD


KINDS = bytes(map(_kind, range(256)))

#: The lower case of the letters that are not odd, byte by byte.
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A or 0x80 <= b <= 0x9E else b for b in range(256))

APOSTROPHE = ord("'")
ENDINGS = np.frombuffer(b"stmd", np.uint8)
LONG_ENDINGS = np.frombuffer(b"revell", ">u2").astype(np.uint16)

NO_RANK = np.iinfo(np.int32).max

#: Pairs are looked up in so many slots (a power of two), by the high bits of their product with an odd number.
SLOT_BITS = 18
SLOT_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _characters(test) -> str:
    return "".join(re.escape(chr(c)) for c in [*range(PLAIN_BELOW), 0x307] if test(chr(c)))


def _byte_characters() -> dict[int, str]:
    """Bytes as printable characters, the rule of byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Runs:
    """Keys numbered in the order they come, each with a run of ids in one flat array."""

    def __init__(self):
        self.index: dict = defaultdict(itertools.count().__next__)
        self.flat = np.zeros(1 << 16, np.int32)
        self.used = 0
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)

    def look_up(self, keys: list[str]) -> tuple[np.ndarray, list[str]]:
        """The numbers of the keys, and the keys without a run so far."""
        known = len(self.index)
        at = np.fromiter(map(self.index.__getitem__, keys), np.int64, len(keys))
        return at, list(itertools.islice(self.index, known, None)) if len(self.index) > known else []

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        """The runs of the keys that had none, in order."""
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat[: self.used], np.zeros(self.used + 2 * len(ids), np.int32)))
        self.flat[self.used : self.used + len(ids)] = ids
        self.starts = np.concatenate((self.starts, self.used + np.cumsum(lengths) - lengths))
        self.lengths = np.concatenate((self.lengths, lengths))
        self.used += len(ids)

    def runs(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the numbered keys, one after another, and their number in each."""
        return gather(self.flat, self.starts, self.lengths, at)


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbered runs of a flat array, one after another, and their lengths."""
    lengths = lengths[at]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts[at] - ends + lengths, lengths) + np.arange(total)], lengths


def cut(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The pieces of a text in UTF-8: where they begin, their sizes, the bytes of all, and which are whole chunks.

    A piece is a word in lower case, or a whole chunk between white space, as it is, that has odd characters or ``<|``.
    """
    values = np.frombuffer(data, np.uint8)
    kinds = np.frombuffer(bytearray(data.translate(KINDS)), np.uint8)
    if b"<|" in data:
        kinds[:-1][(values[:-1] == ord("<")) & (values[1:] == ord("|"))] = ODD
    begins = np.ones(len(data), bool)
    begins[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == NUMBER)
    starts = np.flatnonzero(begins)
    kind, sizes = kinds[starts], np.diff(starts, append=len(data))
    alone = np.flatnonzero((values[starts[:-1]] == APOSTROPHE) & (sizes[:-1] == 1) & (kind[1:] == LETTER))
    if len(alone):
        # An apostrophe takes an ending from the letters after it.
        at = starts[alone + 1]
        one = values[at] | 32
        two = one.astype(np.uint16) << 8 | values[np.minimum(at + 1, len(data) - 1)] | 32
        long = np.isin(two, LONG_ENDINGS) & (sizes[alone + 1] > 1)
        taken = np.where(np.isin(one, ENDINGS), 1, np.where(long, 2, 0))
        starts[alone + 1] += taken
        left = np.ones(len(starts), bool)
        left[alone + 1] = taken < sizes[alone + 1]
        starts, kind = starts[left], kind[left]
    if has_odd := bool((kind == ODD).any()):
        space = kind == SPACE
        chunk = np.cumsum(space)
        odd = np.zeros(int(chunk[-1]) + 1, bool)
        odd[chunk[kind == ODD]] = True
        inside = odd[chunk] & ~space
        kind[inside] = ODD
        # Only the first part of such a chunk begins a piece.
        left = ~inside | np.concatenate(([True], space[:-1]))
        starts, kind = starts[left], kind[left]
    piece = kind != SPACE
    sizes, whole = np.diff(starts, append=len(data))[piece], kind[piece] == ODD
    flat = np.frombuffer(data.translate(LOWER, SPACES), np.uint8)
    if has_odd:
        flat = np.where(np.repeat(whole, sizes), np.frombuffer(data.translate(None, SPACES), np.uint8), flat)
    return starts[piece], sizes, flat, whole


class WordBpe:
    """A word-end BPE vocabulary; ``encode`` and ``decode`` take many texts at once."""

    def __init__(self, path: str = WORD_BPE):
        self.path = path
        with open(path, encoding="utf-8") as f:
            content = json.load(f)
        model, vocab = content["model"], content["model"]["vocab"]
        suffix = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        tokens = {i: t for t, i in [*vocab.items(), *self.special.items()]}
        self.size = max(tokens) + 1
        self.token_bytes = [tokens.get(i, "").encode() for i in range(self.size)]
        to_char = _byte_characters()
        self.to_byte = {c: b for b, c in to_char.items()}
        self.inner = np.array([vocab[to_char[b]] for b in range(256)], np.int32)
        self.final = np.array([vocab[to_char[b] + suffix] for b in range(256)], np.int32)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        self.product = np.array([vocab[a + b] for a, b in pairs], np.int32)
        made = np.full(self.size, -1, np.int64)
        made[self.product] = np.arange(len(pairs))
        # Then a pair with a new symbol always ranks behind the pair that made it, and
        # merging every occurrence of a word's lowest pair at once changes nothing.
        if len(set(self.product.tolist())) < len(pairs) or (np.maximum(made[left], made[right]) >= np.arange(len(pairs))).any():
            raise ValueError("the merges are not in training order")
        keys = left * self.size + right
        # A slot holds the first pair that falls into it; the others are sorted for a binary search.
        slots = self._slots(keys)
        at, first = np.unique(slots, return_index=True)
        self.slot_keys, self.slot_ranks = np.full(1 << SLOT_BITS, -1, np.int64), np.full(1 << SLOT_BITS, NO_RANK, np.int32)
        self.slot_keys[at], self.slot_ranks[at] = keys[first], first
        others = np.setdiff1d(np.arange(len(keys)), first)
        self.order = others[np.argsort(keys[others])].astype(np.int32)
        self.keys = keys[self.order]
        self.shared = np.zeros(1 << SLOT_BITS, bool)
        self.shared[slots[others]] = True
        letters = _characters(lambda c: unicodedata.category(c)[0] == "L")
        numbers = _characters(lambda c: unicodedata.category(c)[0] == "N")
        spaces = "\t-\r \x85\xa0"
        #: The words of a chunk.
        self.split = re.compile(f"[{letters}]+|'(?:[stmd]|re|ve|ll)|[{numbers}]|[^{spaces}{letters}{numbers}]+").findall
        self.beyond = re.compile(f"[^\x00-{chr(PLAIN_BELOW - 1)}]").search
        self._forget()

    @cached_property
    def library(self):
        """Read only where a text needs it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def fresh(self) -> WordBpe:
        """The same vocabulary with nothing remembered."""
        other = copy.copy(self)
        other._forget()
        return other

    def _forget(self) -> None:
        self.chunks, self.in_chunks, self.words = {}, 0, Runs()

    def word_list(self, chunk: str) -> list[str]:
        """The words of an unusual chunk; a special token is a word."""
        if "<|" in chunk and len(parts := self.special_split.split(chunk)) > 1:
            return [w for p in parts for w in ([p] if p in self.special else self.word_list(p))]
        if not self.beyond(chunk):
            return self.split(chunk.lower())
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(chunk))
        return [bytes(map(self.to_byte.__getitem__, p)).decode() for p, _ in pieces]

    def encode(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and their number in each text."""
        if self.in_chunks > REMEMBERED_WORDS:
            self.chunks, self.in_chunks = {}, 0
        if len(self.words.index) > REMEMBERED_WORDS:
            self.words = Runs()
        lines = [t.encode() if t else b"" for t in texts]
        starts, sizes, flat, whole = cut(b"\n".join(lines))
        # Only the distinct pieces become Python objects.
        coded = binaries(flat, sizes).dictionary_encode()
        at, distinct = coded.indices.to_numpy(), coded.dictionary.cast(pa.string())
        is_chunk = np.zeros(len(distinct), bool)
        is_chunk[at[whole]] = True
        place = np.argsort(np.argsort(is_chunk, kind="stable"), kind="stable") if is_chunk.any() else np.arange(len(distinct))
        words, chunks = (distinct.filter(pa.array(chosen)).to_pylist() for chosen in (~is_chunk, is_chunk))
        ids, lengths = gather(*self._ids_of(words, chunks), place[at])
        # A piece belongs to the line that it begins in.
        ends = np.cumsum([len(line) + 1 for line in lines], dtype=np.int64)
        edges = np.concatenate(([0], np.searchsorted(starts, ends)))
        return ids.astype(np.uint32), np.diff(np.concatenate(([0], np.cumsum(lengths)))[edges])

    def _ids_of(self, words: list[str], chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of words, then those of chunks by the words in them: where each begins, and their number."""
        n = len(words)
        # A line end follows the words, and every chunk.
        words = [*words, "\n"]
        for chunk in chunks:
            if chunk not in self.chunks:
                self.chunks[chunk] = [*self.word_list(chunk), "\n"]
                self.in_chunks += len(self.chunks[chunk])
            words += self.chunks[chunk]
        at, new = self.words.look_up(words)
        if new:
            text = "\n".join(w if w != "\n" else "x" for w in new)
            data = np.frombuffer(text.encode() + b"\n", np.uint8)
            ends = np.flatnonzero(data == 10)
            ids, lengths = self.merge(np.delete(data, ends), np.diff(ends, prepend=-1) - 1)
            for i, w in enumerate(new) if "<|" in text or not self.words.used else ():
                if w == "\n" or w in self.special:
                    # A line end has no ids; a special token has its own one.
                    first = int(lengths[:i].sum())
                    own = [self.special[w]] if w in self.special else []
                    ids = np.concatenate((ids[:first], np.array(own, np.int32), ids[first + lengths[i] :]))
                    lengths[i] = len(own)
            self.words.add(ids, lengths)
        ids, lengths = self.words.runs(at)
        ends = np.cumsum(lengths)[n:][at[n:] == self.words.index["\n"]]
        lengths = np.concatenate((lengths[:n], np.diff(ends)))
        return ids, np.cumsum(lengths) - lengths, lengths

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) * self.size + right
        slots = self._slots(keys)
        same = self.slot_keys[slots] == keys
        ranks = np.where(same, self.slot_ranks[slots], NO_RANK)
        more = np.flatnonzero(self.shared[slots] & ~same)
        if len(more):
            at = np.minimum(np.searchsorted(self.keys, keys[more]), len(self.keys) - 1)
            ranks[more] = np.where(self.keys[at] == keys[more], self.order[at], NO_RANK)
        return ranks

    @staticmethod
    def _slots(keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * SLOT_FACTOR >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def merge(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of non-empty words, given by their bytes and sizes, and their number in each."""
        ends = np.cumsum(sizes) - 1
        symbols = self.inner[data]
        symbols[ends] = self.final[data[ends]]
        owner = np.repeat(np.arange(len(sizes)), sizes)
        rank = np.full(len(symbols), NO_RANK, np.int32)
        inside = np.flatnonzero(owner[:-1] == owner[1:])
        rank[inside] = self.ranks(symbols[inside], symbols[inside + 1])
        out_symbols, out_owner = [], []
        while len(symbols):
            starts = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            lowest = np.minimum.reduceat(rank, starts)
            per_word = np.diff(np.append(starts, len(symbols)))
            if (lowest == NO_RANK).any():
                over = np.repeat(lowest == NO_RANK, per_word)
                out_symbols.append(symbols[over])
                out_owner.append(owner[over])
                symbols, owner, rank = symbols[~over], owner[~over], rank[~over]
                per_word, lowest = per_word[lowest != NO_RANK], lowest[lowest != NO_RANK]
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == np.repeat(lowest, per_word))
            # In a run like "aaa" pairs overlap: every other one merges, from the left.
            run = np.concatenate(([0], np.cumsum(np.diff(at) != 1)))
            first = np.flatnonzero(np.concatenate(([True], np.diff(run) != 0)))
            at = at[(np.arange(len(at)) - first[run]) % 2 == 0]
            symbols[at] = self.product[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, owner, rank = symbols[keep], owner[keep], rank[keep]
            at -= np.arange(len(at))
            touched = np.zeros(len(symbols) + 1, bool)
            touched[at] = touched[at - 1] = True
            changed = np.flatnonzero(touched[:-1])
            rank[changed] = NO_RANK
            changed = changed[changed < len(symbols) - 1]
            changed = changed[owner[changed] == owner[changed + 1]]
            rank[changed] = self.ranks(symbols[changed], symbols[changed + 1])
        all_owner = np.concatenate(out_owner)
        return np.concatenate(out_symbols)[np.argsort(all_owner, kind="stable")], np.bincount(all_owner, minlength=len(sizes))

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens of one text joined by spaces, as the library does without a decoder.

        Ids outside the vocabulary are passed over.
        """
        kept = ids[ids < self.size].tolist()
        return b" ".join(filter(None, map(self.token_bytes.__getitem__, kept)))


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> WordBpe:
    """One in each Python worker."""
    return WordBpe(path)


def load(path: str = WORD_BPE) -> WordBpe:
    """An encoder for one task: what it remembers goes when the task ends."""
    return _vocabulary(path).fresh()


def encode(docs: DataFrame, path: str = WORD_BPE, text: str = "text") -> DataFrame:
    """Replaces the text column by ``n_tokens`` and ``ids``: little-endian unsigned 32-bit integers."""

    def prepare():
        bpe = load(path)

        def work(texts):
            ids, counts = bpe.encode(texts)
            return {"n_tokens": counts, "ids": binaries(ids.astype("<u4"), counts, 4)}

        return work

    return map_texts(docs, "n_tokens long, ids binary", prepare, text)


def round_trip(docs: DataFrame, path: str = WORD_BPE, text: str = "text") -> DataFrame:
    """As ``encode``, with the decoded text beside the ids, in one pass over the texts."""

    def prepare():
        bpe = load(path)

        def work(texts):
            ids, counts = bpe.encode(texts)
            edges = np.concatenate(([0], np.cumsum(counts)))
            decoded = [bpe.decode(ids[a:b]).decode() for a, b in zip(edges[:-1], edges[1:], strict=True)]
            return {"n_tokens": counts, "ids": binaries(ids.astype("<u4"), counts, 4), "decoded": decoded}

        return work

    return map_texts(docs, "n_tokens long, ids binary, decoded string", prepare, text)


def decode(encoded: DataFrame, path: str = WORD_BPE, ids: str = "ids") -> DataFrame:
    """Replaces the column of ids by ``decoded`` text; null ids give an empty text."""

    def prepare():
        bpe = load(path)
        return lambda values: {"decoded": [bpe.decode(np.frombuffer(v or b"", "<u4")).decode() for v in values]}

    return map_texts(encoded, "decoded string", prepare, ids)
