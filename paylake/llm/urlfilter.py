"""URL rules, and a naive Bayes verdict on the words in a URL where no rule fits.

Names run words together. A unigram Viterbi search splits every run of letters of host
and path into the likeliest words, by the ranks of a public vocabulary; percent-encoding is undone before, and a run with
letters of other scripts is a word of its own. A multinomial
naive Bayes classifier over the words, told apart by whether they stand in host or path,
learns from the URLs that the rules decide, all of them, and judges the others.
Words are hashed to ``BUCKETS`` features, so the model has a fixed size.

Defined results: a null URL or one without ``://`` has an empty host and path; no
rule fits these, and they are allowed, having no words. Repeated rows get equal results.
Without any URL that a rule decides only the seed words count.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylake.llm.bpe import WORD_BPE
from paylake.llm.common import bounded_batches, pick, ragged

#: Features of the model.
BUCKETS = 1 << 16

#: Longest word that a split may contain.
LONGEST_WORD = 24

#: Splits that a task remembers.
REMEMBERED = 50_000

#: Log odds from which a URL is blocked.
THRESHOLD = 1.0

#: Words that mark unwanted pages before anything is learned. Each counts in
#: the blocked class as if it made up this share of its words.
SEED_WORDS = (
    "adult", "bet", "betting", "bingo", "casino", "escort", "gambling", "jackpot", "loan", "loans", "lottery",
    "nude", "pills", "poker", "porn", "sex", "slots", "spam", "viagra", "xxx",
)
SEED_SHARE = 0.005

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Runs of letters of any script, and of digits.
RUNS = re.compile(r"[^\W\d_]+|[0-9]+")

Rule = tuple[str, str]


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(F.col(url)))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return pages.withColumn("host", host).withColumn("path", F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1))


def with_rule(parts: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds ``rule``, the longest that fits, and its ``action``.

    Rules are (action, host followed by the beginning of a path). They become conditions
    of one expression, so their number should stay in the thousands.
    """

    def fits(rule: str) -> Column:
        host, slash, path = rule.partition("/")
        own = (F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))
        return own & F.startswith(F.col("path"), F.lit(slash + path))

    name = action = F.lit(None).cast("string")
    for kind, rule in sorted(rules, key=lambda r: len(r[1])):
        name = F.when(fits(rule), F.lit(rule)).otherwise(name)
        action = F.when(fits(rule), F.lit(kind)).otherwise(action)
    return parts.withColumn("rule", name).withColumn("action", action)


class Splitter:
    """Splits runs of letters into the likeliest words of a vocabulary file."""

    def __init__(self, path: str = WORD_BPE):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        end = model["end_of_word_suffix"]
        words = [t[: -len(end)] for t, _ in sorted(model["vocab"].items(), key=lambda x: x[1]) if t.endswith(end)]
        words = [w for w in words if w.isascii() and w.isalpha() and len(w) <= LONGEST_WORD]
        # Frequencies by rank, after Zipf. Single letters stand at the front of the file, not by frequency.
        self.total = math.log(len(words)) + math.log(math.log(len(words)))
        self.cost = {w: self.total + math.log(rank + 10) - math.log(10) for rank, w in enumerate(words) if len(w) > 1}
        self.letter = 2 * self.total
        self.seen: dict[str, tuple[str, ...]] = {}

    def split(self, run: str) -> tuple[str, ...]:
        if (known := self.seen.get(run)) is not None:
            return known
        best, back = [0.0], [0]
        for end in range(1, len(run) + 1):
            choice = (best[end - 1] + self.letter, end - 1)
            for start in range(max(0, end - LONGEST_WORD), end - 1):
                cost = self.cost.get(run[start:end])
                if cost is not None and best[start] + cost < choice[0]:
                    choice = (best[start] + cost, start)
            best.append(choice[0])
            back.append(choice[1])
        words, end = [], len(run)
        while end:
            words.append(run[back[end] : end])
            end = back[end]
        if len(self.seen) >= REMEMBERED:
            self.seen.clear()
        self.seen[run] = tuple(reversed(words))
        return self.seen[run]

    def words(self, text: str) -> list[str]:
        """All words of a text, percent-encoding undone; numbers stand as their length.

        Runs of a-z are split; a run with other letters is a word of its own.
        """
        out: list[str] = []
        for run in RUNS.findall(unquote(text).lower()):
            if run[0] in "0123456789":
                out.append(f"#{min(len(run), 9)}")
            else:
                out += self.split(run) if run.isascii() else [run]
        return out


@lru_cache(maxsize=2)
def _splitter(path: str) -> Splitter:
    return Splitter(path)


def feature(place: str, word: str) -> int:
    from xxhash import xxh3_64_intdigest

    return xxh3_64_intdigest(f"{place}:{word}") % BUCKETS


def features(parts: DataFrame, path: str = WORD_BPE) -> DataFrame:
    """Adds ``features``: the hashed words of host and path, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = _splitter(path)
        for batch in batches:
            rows = [
                [feature(place, w) for place, text in (("host", h), ("path", p)) for w in splitter.words(text or "")]
                for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True)
            ]
            flat = pa.array([x for r in rows for x in r], pa.int32())
            found = pa.ListArray.from_arrays(pa.array(ragged([len(r) for r in rows]), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, "features"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    return bounded_batches(parts).mapInArrow(run, f"{schema}, features array<int>")


def fit(judged: DataFrame) -> np.ndarray:
    """Log odds for ``block`` of every feature, and of the classes at the end.

    From all rows of (action, features) that have an action. What comes back is at most a row for each feature.
    """
    rows = judged.where("action is not null").select("action", F.explode("features").alias("feature"))
    counts = np.zeros((2, BUCKETS))
    for r in rows.groupBy("feature").agg(F.count_if(F.col("action") == "block").alias("block"), F.count("*").alias("all")).collect():
        counts[:, r.feature] = r["all"] - r.block, r.block
    urls = {r.action: r["count"] for r in judged.where("action is not null").groupBy("action").count().collect()}
    seeds = np.zeros(BUCKETS)
    for word in SEED_WORDS:
        for place in ("host", "path"):
            seeds[feature(place, word)] += 1
    counts[1] += seeds * SEED_SHARE * max(counts[1].sum(), 1 / SEED_SHARE)
    smooth = (counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * BUCKETS)
    # A word that neither class has says nothing; only the seeds are there without rows.
    odds = np.where(counts.sum(axis=0) > 0, np.log(smooth[1]) - np.log(smooth[0]), 0.0)
    prior = math.log((urls.get("block", 0) + 1) / (urls.get("allow", 0) + 1))
    return np.append(odds, prior)


def score(rows: DataFrame, odds: np.ndarray) -> DataFrame:
    """Replaces ``features`` by ``log_odds`` for block; 0 without features."""
    names = [c for c in rows.columns if c != "features"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("features")
            counts = np.diff(column.offsets.to_numpy())
            flat = column.flatten().to_numpy(zero_copy_only=False)
            owner = np.repeat(np.arange(len(counts)), counts)
            sums = np.bincount(owner, odds[flat], len(counts)) + np.where(counts > 0, odds[BUCKETS], 0.0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sums)], names=[*names, "log_odds"])

    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in names)
    return rows.mapInArrow(run, f"{schema}, log_odds double")


def prepare(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(page_id, host, path, rule, action, features) of pages."""
    return features(with_rule(with_parts(pick(pages, "page_id", "url")), rules).drop("url"))
