"""Token counts by a two-tier lookup of pre-token lengths, where the texts are read.

A byte-level BPE tokenizer splits a text into pre-tokens and each of them into tokens, whatever
stands around it, so a text's count is the sum of its pre-tokens' counts. The frequent pre-tokens'
counts are found once and broadcast as a compact table (first tier); each worker encodes the others
when it meets them and keeps their counts in a bounded cache (second tier). No pre-token is shuffled:
a text's count never leaves the row it belongs to.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The frequent pre-tokens are those of so many documents, drawn at random; they decide on speed only.
SAMPLE_ROWS = 4096
#: Entries of the broadcast table, and of a worker's cache (two generations of half that size).
FREQUENT = 32_768
CACHED = 400_000
#: Longer pre-tokens are encoded each time, so that an entry's size is bounded.
LONGEST = 64
#: Tasks that count the sample; each sends FREQUENT entries to the driver at most.
SAMPLE_TASKS = 8
#: Texts that a task holds as Python strings at a time.
TOGETHER = 256


class PreTokens:
    """The pre-tokens of a text as the tokenizer itself would split it, or None where that is not certain.

    The tokenizer's pattern is run by ``regex``, whose tables may be of another Unicode version: the class
    of each character outside ASCII is compared with the tokenizer's when it is first seen. Texts
    with a character the two see differently, or with a string of a special token, give None.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec.get("pre_tokenizer") or {}
        if spec["model"]["type"] != "BPE" or spec.get("normalizer") or split.get("type") != "ByteLevel" or not split.get("use_regex", True) or split.get("add_prefix_space"):
            raise ValueError(f"{path} is no byte-level BPE tokenizer without normalizer and added space")
        self.tokenizer = Tokenizer.from_file(path)
        # Fixed values of this kind of tokenizer: the pre-tokenising pattern of byte-level BPE.
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+").findall
        self._kind = regex.compile(r"(\p{L})|(\p{N})|(\s)").match
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = re.compile("|".join(map(re.escape, special))).search if special else lambda text: None
        self.alike = {chr(i) for i in range(128)}
        self.unlike: set[str] = set()

    def _classes_agree(self, c: str) -> bool:
        seen = self._kind(c)
        here = seen.lastindex if seen else 0
        whole = lambda before: len(self.tokenizer.pre_tokenizer.pre_tokenize_str(before + c)) == 1
        return here == (1 if whole("a") else 2 if whole("1") else 0 if whole("!") else 3)

    def __call__(self, text: str) -> list[str] | None:
        if self.special(text):
            return None
        if not text.isascii():
            chars = set(text)
            for c in chars - self.alike - self.unlike:
                (self.alike if self._classes_agree(c) else self.unlike).add(c)
            if self.unlike and not self.unlike.isdisjoint(chars):
                return None
        return self.split(text)


class Lengths(dict):
    """Number of tokens of a pre-token: the frequent ones as items, the others through a bounded cache."""

    def __init__(self, path: str, frequent: dict[str, int]):
        super().__init__(frequent)
        self.pre_tokens = PreTokens(path)
        self.tokenizer = self.pre_tokens.tokenizer
        self.model = self.tokenizer.model
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}
        # Byte-level BPE spells printable bytes as themselves and the rest as code points from 256 on.
        plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        rest = iter(range(256, 512))
        self.spell = [chr(b) if b in plain else chr(next(rest)) for b in range(256)]

    def __missing__(self, word: str) -> int:
        n = self.young.get(word)
        if n is None:
            n = self.old.get(word)
            if n is None:
                n = self.encode(word)
            if len(word) <= LONGEST:
                if len(self.young) >= CACHED // 2:
                    self.old, self.young = self.young, {}
                self.young[word] = n
        return n

    def encode(self, word: str) -> int:
        return len(self.model.tokenize("".join([self.spell[b] for b in word.encode()])))

    def count(self, text: str) -> int:
        words = self.pre_tokens(text)
        if words is None:
            return len(self.tokenizer.encode(text, add_special_tokens=False))
        return sum(map(self.__getitem__, words))


#: One table a worker: (tokenizer, key of the broadcast table) and the lengths.
_lengths: tuple[tuple, Lengths] | None = None


def _worker_lengths(path: str, table) -> Lengths:
    global _lengths
    key = (path, table.key)
    if _lengths is None or _lengths[0] != key:
        _lengths = (key, Lengths(path, table.unpack()))
    return _lengths[1]


class FrequentTable:
    """Pre-tokens and their numbers of tokens, packed for the broadcast: one Arrow column of strings, one of small numbers."""

    def __init__(self, counts: dict[str, int]):
        words = sorted(counts)
        self.key = hash(tuple(words))
        self.words, self.lengths = pa.array(words, pa.string()), pa.array([counts[w] for w in words], pa.int32())

    def unpack(self) -> dict[str, int]:
        return dict(zip(self.words.to_pylist(), self.lengths.to_pylist()))


def frequent_lengths(docs: DataFrame, tokenizer_path: str, text_col: str = "text", rows: int = SAMPLE_ROWS, entries: int = FREQUENT) -> FrequentTable:
    """The table of the pre-tokens that are most frequent in about ``rows`` documents drawn at random.

    The sample is dealt whole to ``SAMPLE_TASKS`` tasks; each counts in bounded memory and sends
    its ``entries`` most frequent pre-tokens, so the driver's share does not grow with the table.
    """
    n = docs.count()
    drawn = docs.select(F.col(text_col).alias("text")).where("text IS NOT NULL")
    if n > rows:
        drawn = drawn.sample(fraction=rows / n, seed=17)

    def count(batches: Iterator) -> Iterator:
        split, seen = PreTokens(tokenizer_path), Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                for text in batch["text"].slice(at, TOGETHER).to_pylist():
                    seen.update([w for w in split(text) or () if len(w) <= LONGEST])
                if len(seen) > 16 * entries:
                    seen = Counter(dict(seen.most_common(4 * entries)))
        best = seen.most_common(entries)
        yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in best], pa.string()), pa.array([k for _, k in best], pa.int64())], names=["word", "n"])

    found = drawn.repartition(SAMPLE_TASKS).mapInArrow(count, "word string, n long").toArrow()
    total: Counter = Counter()
    for w, k in zip(found["word"].to_pylist(), found["n"].to_pylist()):
        total[w] += k
    encode = Lengths(tokenizer_path, {}).encode
    return FrequentTable({w: encode(w) for w, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:entries]})


def count_tokens(docs: DataFrame, tokenizer_path: str, text_col: str = "text", limit: int = 1024, frequent: FrequentTable | None = None) -> DataFrame:
    """``docs`` with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > ``limit``) as new columns.

    Counts are the library's own, without added special tokens; strings of special tokens inside a
    text count as the library has them by default, as one token each. A null or empty text has 0
    tokens and 0 bytes. Rows with null ids and repeated rows are counted each; an empty table
    gives no rows. All other columns stay; columns named like the new ones are replaced.
    """
    table = frequent or frequent_lengths(docs, tokenizer_path, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(table)

    @F.arrow_udf("long")
    def tokens(texts: pa.Array) -> pa.Array:
        count = _worker_lengths(tokenizer_path, shared.value).count
        out: list[int] = []
        for at in range(0, len(texts), TOGETHER):
            out += [count(t) if t else 0 for t in texts.slice(at, TOGETHER).to_pylist()]
        return pa.array(out, pa.int64())

    counted = docs.withColumns(
        {"n_bytes": F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long"), "n_tokens": tokens(F.col(text_col))}
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

