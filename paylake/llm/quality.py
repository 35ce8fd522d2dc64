"""Quality rules: counts of words, lines and symbols, and how well a public tokenizer fits the text.

Natural text in a language that a vocabulary knows comes out in tokens of a typical
length, with few bytes that have no token of their own and with a typical variety
of tokens. Text far outside is boilerplate, tables, shouting or noise. The measures,
by a public sentencepiece vocabulary, word by word:

* ``chars_per_token``: code points in words, by token;
* ``tokens_per_word``;
* ``byte_share``: the share of byte-fallback tokens;
* ``token_entropy``: the entropy of the document's tokens, in bits.

Each language, and each script, has bands for them. They are fitted as quantiles of
all documents labelled good; where there are too few, wide bands by script hold.

Defined results: a null text has no words and fails the base rules, as an empty one
does; a document without a language, or in one without bands, takes those of its
script; rows are judged one by one, so repeated rows get equal verdicts.
"""

from __future__ import annotations

import itertools
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.bpe import REMEMBERED_WORDS, Runs
from paylake.llm.common import map_texts, pick, stored
from paylake.operators.keys import bit_set, restrict

PIECES = public_tokenizers.path("piece_bpe_32k.model")

#: With fewer labelled documents a language or script has no bands of its own.
LEAST_LABELLED = 100

#: The share of good documents that may lie beyond each edge of a band.
TAIL = 0.001

#: The share at each end whose values are told apart when edges are fitted: more than ``TAIL``, also of ``LEAST_LABELLED``.
INNER = 0.03

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

SYMBOLS = "#*$%&|<>"
WHITE = "\t\n\v\f\r "

#: Code points of scripts that are told apart: fixed values of the Unicode charts.
SCRIPTS = {
    "greek": "Ͱ-Ͽἀ-῿",
    "cyrillic": "Ѐ-ԯ",
    "hebrew": "֐-׿",
    "arabic": "؀-ۿݐ-ݿ",
    "devanagari": "ऀ-ॿ",
    "thai": "฀-๿",
    "kana": "぀-ヿ",
    "han": "㐀-䶿一-鿿",
    "hangul": "ᄀ-ᇿ가-힯",
}

#: Lowest and highest chars_per_token and tokens_per_word, highest byte_share and lowest
#: token_entropy where nothing is fitted.
WIDE = {"latin": (1.2, 8.0, 1.0, 8.0, 0.2, 2.0), "other": (0.25, 8.0, 1.0, 1e9, 0.95, 2.0)}

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_tokens long, chars_per_token double, tokens_per_word double, byte_share double, token_entropy double, script string"
)

FITTED = ("chars_per_token", "tokens_per_word", "byte_share", "token_entropy")


@lru_cache(maxsize=2)
def _vocabulary(path: str):
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=path)
    return pieces, np.array([pieces.is_byte(i) for i in range(pieces.get_piece_size())])


def script_of(text: str) -> str:
    """The script with most letters; ``none`` without letters."""
    beyond = re.search("[^\\x00-ɏ]", text)
    if beyond is None:
        return "latin" if re.search("[A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ]", text) else "none"
    numbers = {s: len(re.findall(f"[{r}]", text)) for s, r in SCRIPTS.items()}
    numbers["latin"] = len(re.findall("[A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏḀ-ỿ]", text))
    best = max(numbers, key=numbers.get)
    return best if numbers[best] else "other" if any(map(str.isalpha, text)) else "none"


def duplicate_lines(text: str) -> int:
    """Lines with a word that are equal to an earlier line."""
    lines = text.split("\n")
    if len(set(lines)) == len(lines):
        return 0
    lines = [x for x in lines if x.strip(WHITE)]
    return len(lines) - len(set(lines))


def repeated_words(words: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Words of each text in windows of three words that the text has twice or more.

    ``words`` are word numbers, of all texts one after another, and ``edges`` where texts begin.
    """
    covered = np.zeros(len(words), bool)
    owner = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    if len(words) >= 3:
        first, second, third = words[:-2], words[1:-1], words[2:]
        size = int(words.max()) + 1
        if size < 1 << 21:
            key = first << 42 | second << 21 | third
        else:
            key = np.unique(first * size + second, return_inverse=True)[1] * size + third
        # Equal windows of a text stand together: texts are in order and the sort is stable.
        order = np.argsort(key, kind="stable")
        order = order[owner[order] == owner[order + 2]]
        same = (key[order[1:]] == key[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
        twice = order[np.concatenate(([False], same)) | np.concatenate((same, [False]))] if len(order) else order
        for shift in range(3):
            covered[twice + shift] = True
    return np.bincount(owner[covered], minlength=len(edges) - 1)


class _Measure:
    def __init__(self, path: str):
        self.pieces, self.is_byte = _vocabulary(path)
        self.seen = Runs()

    def __call__(self, texts: list[str | None]) -> dict:
        if len(self.seen.index) > REMEMBERED_WORDS:
            self.seen = Runs()
        texts = [t or "" for t in texts]
        words: list[bytes] = []
        edges = [0]
        for text in texts:
            words += text.encode().split()
            edges.append(len(words))
        at, new = self.seen.look_up(words)
        if new:
            runs = self.pieces.encode([w.decode() for w in new])
            flat = np.fromiter(itertools.chain.from_iterable(runs), np.int32)
            self.seen.add(flat, np.fromiter(map(len, runs), np.int64, len(runs)))
        tokens, lengths = self.seen.runs(at)
        edges = np.array(edges)
        token_edges = np.concatenate(([0], np.cumsum(lengths)))[edges]
        n_tokens = np.diff(token_edges)
        owner = np.repeat(np.arange(len(texts)), n_tokens)
        bytes_in = np.bincount(owner, self.is_byte[tokens], len(texts))
        size = len(self.is_byte)
        kinds, counts = np.unique(owner * size + tokens, return_counts=True)
        total = np.maximum(n_tokens, 1)
        share = counts / total[kinds // size]
        entropy = np.bincount(kinds // size, -share * np.log2(share), len(texts))
        word_chars = np.array([len(t) - sum(map(t.count, WHITE)) for t in texts], np.int64)
        return {
            "n_words": np.diff(edges),
            "word_chars": word_chars,
            "n_symbols": np.array([sum(map(t.count, SYMBOLS)) for t in texts], np.int64),
            "n_dup_lines": np.array([duplicate_lines(t) for t in texts], np.int64),
            "n_repeat_words": repeated_words(at, edges),
            "n_tokens": n_tokens,
            "chars_per_token": word_chars / total,
            "tokens_per_word": n_tokens / np.maximum(np.diff(edges), 1),
            "byte_share": bytes_in / total,
            "token_entropy": np.maximum(entropy, 0.0),
            "script": [script_of(t) for t in texts],
        }


def measure(docs: DataFrame, path: str = PIECES, keep_text: bool = False) -> DataFrame:
    """Adds the counts and measures; the text column goes unless it is to be kept."""
    return map_texts(docs, MEASURES, lambda: _Measure(path), keep_text=keep_text)


def base_failed() -> Column:
    few = F.col("n_words") < MIN_WORDS
    return few | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))


def fit_bands(docs: DataFrame, labels: DataFrame, path: str = PIECES) -> dict:
    """Bands by ("lang" or "script", name), from all documents labelled good.

    Texts stay where they are read: a bit set of the labelled ids drops most others before they are measured, then
    the measures alone are joined. Quantiles are exact; values that lie well inside count as one, so a group
    brings together its tails only.
    """
    known = pick(docs, "doc_id", "lang", "text")
    good = pick(labels, "doc_id", "quality").where("quality = 1").select(F.col("doc_id").cast(known.schema["doc_id"].dataType))
    near = measure(bit_set(good, "doc_id").maybe(known, "doc_id"), path).where(~base_failed())
    rows = stored(restrict(near, good, "doc_id").select("lang", "script", *FITTED), "labelled")
    either = F.explode(F.array(*(F.struct(F.lit(k).alias("by"), F.col(k).alias("name")) for k in ("lang", "script"))))
    keyed = rows.select(either.alias("_key"), *FITTED).select("_key.by", "_key.name", *FITTED).where("name is not null")
    inner = [F.percentile_approx(c, [INNER, 1 - INNER], 10_000).alias(f"_{c}") for c in FITTED]
    groups = keyed.groupBy("by", "name").agg(F.count("*").alias("_n"), *inner).where(F.col("_n") >= LEAST_LABELLED)
    edges = F.array(F.lit(TAIL), F.lit(1 - TAIL))
    found = {}
    for r in (
        keyed.join(F.broadcast(groups), ["by", "name"])
        .groupBy("by", "name")
        .agg(*(F.percentile(_ends(c), edges).alias(c) for c in FITTED))
        .collect()
    ):
        found[r.by, r.name] = (*r.chars_per_token, *r.tokens_per_word, r.byte_share[1], r.token_entropy[0])
    return found


def _ends(column: str) -> Column:
    """The value, or the lower inner bound for all values between the bounds: the order of the tails is unchanged."""
    low, high = F.col(f"_{column}")[0], F.col(f"_{column}")[1]
    return F.when((F.col(column) > low) & (F.col(column) < high), low).otherwise(F.col(column))


def judge(measured: DataFrame, bands: dict) -> DataFrame:
    """Adds ``base_failed`` and ``kept`` to measured documents that have a ``lang`` column."""

    def inside(band) -> Column:
        low, high, low_words, high_words, most_bytes, least_entropy = band
        return (
            F.col("chars_per_token").between(low, high)
            & F.col("tokens_per_word").between(low_words, high_words)
            & (F.col("byte_share") <= most_bytes)
            & (F.col("token_entropy") >= least_entropy)
        )

    # A band for each language and script: few conditions on one row, no join.
    verdict = F.when(F.col("script") == "latin", inside(WIDE["latin"])).otherwise(inside(WIDE["other"]))
    for by in ("script", "lang"):
        chain = None
        for (kind, name), band in sorted(bands.items()):
            if kind == by:
                chain = (F if chain is None else chain).when(F.col(by) == name, inside(band))
        if chain is not None:
            verdict = chain.otherwise(verdict)
    return measured.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict)
