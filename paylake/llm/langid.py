"""Language identification by compression.

For each language a zstandard dictionary of raw content is made from labelled
documents. A text is compressed with each dictionary; the language whose dictionary
makes it smallest wins. Case and all characters but letters are levelled first; vowel signs that are marks of their own,
as in Indic scripts, count as spaces, in texts and dictionaries alike.
Long texts are compressed in pieces, so that the dictionary counts all along the
text and not only where it begins; short ones in several rotations, as one size in
whole bytes says little. A narrow margin to the second language is a rejection.

Defined results: ``und`` with score 0 for a null text, one without a letter, or where
nothing could be learned; of equal sizes the first language by name wins, with
score 0; repeated rows give equal results.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylake.llm.common import map_texts, pick, sampled

#: Labelled documents for each language, about, that a dictionary is made of.
SAMPLE_PER_LANGUAGE = 200

#: Of longer documents the beginning goes into dictionaries, behind the shorter documents.
SAMPLE_CHARS = 8192

#: Bytes of a dictionary, at most.
DICTIONARY_BYTES = 64_000

#: Bytes compressed together.
PIECE_BYTES = 2048

#: A shorter text is compressed in ``ROTATIONS`` rotations.
SHORT_BYTES = 512
ROTATIONS = 8

LEVEL = 6

#: A document is rejected if the best size is not smaller than the second by this share.
MIN_MARGIN = 0.02

UNKNOWN = "und"

NO_LETTERS = re.compile(r"[\W\d_]+")


def levelled(text: str) -> bytes:
    return NO_LETTERS.sub(" ", text.lower()).encode()


def fit(docs: DataFrame, sample: int = SAMPLE_PER_LANGUAGE) -> dict[str, bytes]:
    """A dictionary for each language, from (doc_id, text, lang) rows.

    What reaches the driver is bounded: about ``sample`` documents for each language, of each at
    most ``SAMPLE_CHARS`` characters from its first letter on.
    """
    usable = pick(docs, "doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") > 0)
    )
    is_long = F.length("text") > SAMPLE_CHARS
    start = F.regexp_replace("text", r"^[^\p{L}]+", "").substr(1, SAMPLE_CHARS)
    pieces = sampled(usable, "lang", sample).select("doc_id", "lang", is_long.alias("cut"), F.when(is_long, start).otherwise(F.col("text")).alias("text"))
    chosen = pieces.orderBy("lang", "cut", F.xxhash64("doc_id"), "doc_id", "text").collect()
    made: dict[str, dict[str, None]] = {}
    for row in chosen:
        if any(map(str.isalpha, row.text)):
            made.setdefault(row.lang, {})[row.text] = None
    return {lang: b"\n".join(map(levelled, texts))[:DICTIONARY_BYTES] for lang, texts in made.items()}


class _Predict:
    def __init__(self, dictionaries: dict[str, bytes]):
        import zstandard

        self.languages = sorted(dictionaries)
        self.compressors = []
        for lang in self.languages:
            content = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=LEVEL)
            self.compressors.append(
                zstandard.ZstdCompressor(level=LEVEL, dict_data=content, write_checksum=False, write_content_size=False, write_dict_id=False)
            )

    def one(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        if len(self.languages) == 1:
            return self.languages[0], 1.0
        data = levelled(text)
        if len(data) < SHORT_BYTES:
            parts = [data[a:] + data[:a] for a in range(0, len(data), max(1, len(data) // ROTATIONS))]
        else:
            parts = [data[a : a + PIECE_BYTES] for a in range(0, len(data), PIECE_BYTES)]
        sizes = [sum(len(c.compress(p)) for p in parts) for c in self.compressors]
        best = min(range(len(sizes)), key=sizes.__getitem__)
        second = min(s for i, s in enumerate(sizes) if i != best)
        return self.languages[best], (second - sizes[best]) / second

    def __call__(self, texts: list[str | None]) -> dict:
        found = [self.one(t) for t in texts]
        return {"lang_pred": pa.array([f[0] for f in found], pa.string()), "score": pa.array([f[1] for f in found], pa.float64())}


def predict(docs: DataFrame, dictionaries: dict[str, bytes], keep_text: bool = False) -> DataFrame:
    """Adds ``lang_pred`` and ``score``, the margin to the second language; the text goes unless it is to be kept."""
    return map_texts(docs, "lang_pred string, score double", lambda: _Predict(dictionaries), keep_text=keep_text)


def held_out(doc_id: str = "doc_id"):
    """Documents that nothing is learned from; one without an id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))
