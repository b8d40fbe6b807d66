"""Hierarchical packing of token sequences into windows of several lengths.

Each document is tokenised once, where it is read, and cut into full long windows and one rest.
Every piece is routed to the shortest tier that holds it whole. Packing works on the histogram of
piece lengths, which has at most one row per length whatever the input: the long tier opens a
window with each of its pieces and fills the gap from shorter ones; then each shorter tier packs
what is left into windows of exactly its own length; what fits no such window goes to long ones.
The plan says how many pieces of each length go to which kind of window; pieces find their places
by their rank among the pieces of their length, so no document ids pass through the driver.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabcast.llm.common import hash_bucket, materialise, split_rank

TIERS = (256, 512, 1024, 2048)
END_ID = 1
#: Words whose ids a task keeps at hand; the memory of a task stays bounded at any vocabulary.
WORDS_KEPT = 300_000
#: Bytes of texts that a task encodes at a time, about.
TEXT_BYTES = 6_000_000
#: Special-token marks and white space beyond ASCII's own.
ODD_TEXT = r"<\||[\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Characters that a word has beside plain Latin ones, and the tokenizer file's pre-tokenising pattern.
ODD_WORD = r"[^\x00-\x{12f}\x{132}-\x{24f}]"
PART = r"('s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+)"

_PIECES = (
    "doc_id long, start long, length int, ids_crc32 long, doc_tokens long, row_key long"
)


class WordEncoder:
    """Ids of a lower-casing, white-space-dropping BPE tokenizer, with the ids of common words at hand.

    The tokenizer splits at white space before anything else, so a text's ids are its words' ids in
    order. Words in plain Latin letters are split by the tokenizer's own pattern and sent to its model;
    all others, and texts with special-token marks or rare white space, go to the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        # Byte-level BPE spells printable bytes as themselves and the rest as code points from 256 on.
        plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        rest = iter(range(256, 512))
        self.spell = {b: chr(b) if b in plain else chr(next(rest)) for b in range(256)}
        #: Ids as bytes, of what was looked up lately and of what was before that.
        self.words: list[dict[str, bytes]] = [{}, {}]
        self.parts: list[dict[str, bytes]] = [{}, {}]

    def _word(self, w: str) -> bytes:
        return array("I", self.tokenizer.encode(w, add_special_tokens=False).ids).tobytes()

    def _part(self, part: str) -> bytes:
        # Printable ASCII is spelt as itself.
        spelt = part if part.isascii() and part.isprintable() else part.encode().decode("latin-1").translate(self.spell)
        return array("I", [t.id for t in self.model.tokenize(spelt)]).tobytes()

    @staticmethod
    def _looked_up(values, known: list[dict[str, bytes]], make):
        """The ids of all ``values`` (an Arrow array), one after the other, and how many each has."""
        import numpy as np

        found, (young, old) = [], known
        for v in values.to_pylist():
            ids = young.get(v)
            if ids is None:
                ids = old.get(v)
                if ids is None:
                    ids = make(v)
                if len(young) >= WORDS_KEPT:
                    old, young = young, {}
                young[v] = ids
            found.append(ids)
        known[:] = young, old
        return np.frombuffer(b"".join(found), dtype="=u4"), np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4

    def _words(self, words):
        """``_looked_up`` of words that hold no white space: plain ones by their different parts."""
        import numpy as np
        import pyarrow.compute as pc

        odd = pc.match_substring_regex(words, ODD_WORD)
        ids, size = self._looked_up(words.filter(odd), self.words, self._word)
        if len(size) == len(words):
            return ids, size
        plain = pc.utf8_lower(words.filter(pc.invert(odd)))
        # Words of letters alone are one part each.
        mixed = pc.invert(pc.utf8_is_alpha(plain))
        plain = pc.replace_with_mask(plain, mixed, pc.replace_substring_regex(plain.filter(mixed), PART, r"\1 "))
        split = pc.ascii_split_whitespace(plain)
        parts = split.flatten().dictionary_encode()
        part_ids, part_n = _taken(*self._looked_up(parts.dictionary, self.parts, self._part), parts.indices.to_numpy())
        after = np.append(0, np.cumsum(part_n))[split.offsets.to_numpy()]
        if not len(size):
            return part_ids, np.diff(after)
        # Odd words lie behind the plain ones until all are taken in their order.
        order, odd = np.empty(len(words), dtype=np.int64), odd.to_numpy(zero_copy_only=False)
        order[~odd], order[odd] = np.arange(len(plain)), np.arange(len(plain), len(words))
        return _taken(np.concatenate([part_ids, ids]), np.concatenate([np.diff(after), size]), order)

    def encode(self, texts):
        """The ids of all ``texts`` (an Arrow array), one text after the other, and where each text's end.

        The different words of the texts are looked up once each."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        split = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
        words = split.flatten().dictionary_encode()
        at = words.indices.to_numpy()
        out, n = _taken(*self._words(words.dictionary), at)
        stop = split.offsets.to_numpy()[1:].astype(np.int64)
        ends = np.append(0, np.cumsum(n))[stop]
        odd = pc.match_substring_regex(words.dictionary, ODD_TEXT).to_numpy(zero_copy_only=False)
        if odd.any():
            parts = np.split(out, ends[:-1])
            for i in np.unique(np.searchsorted(stop, np.flatnonzero(odd[at]), side="right")).tolist():
                parts[i] = np.frombuffer(self._word(texts[i].as_py()), dtype="=u4")
            out, ends = np.concatenate(parts), np.cumsum([len(p) for p in parts])
        return out, ends


def _taken(ids, size, at):
    """The runs of ``ids`` (``size`` says how long each is) that ``at`` names, one after the other, and their sizes."""
    import numpy as np

    n = size[at]
    before = (np.cumsum(size) - size)[at] - np.cumsum(n) + n
    return ids[np.repeat(before, n) + np.arange(int(n.sum()))], n


_encoders: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def tokenised_pieces(docs: DataFrame, tokenizer_path: str, window: int = TIERS[-1], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: the document's ids and the end id, cut at every ``window`` ids.

    Ids themselves stay in the task; a piece carries its place, length and checksum.
    """
    end = END_ID

    def pieces(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        encode = _encoder(tokenizer_path).encode
        for whole in batches:
            step = max(1, whole.num_rows * TEXT_BYTES // max(whole["_text"].nbytes, 1))
            for first in range(0, whole.num_rows, step):
                batch = whole.slice(first, step)
                out, ends = encode(batch["_text"])
                rows: list[tuple] = []
                begin = 0
                for doc_id, key, stop in zip(batch["_id"].to_pylist(), batch["_key"].to_pylist(), ends.tolist()):
                    ids = np.append(out[begin:stop], np.uint32(end)).astype("<u4")
                    begin = stop
                    for at in range(0, len(ids), window):
                        part = ids[at : at + window]
                        rows.append((doc_id, at, len(part), zlib.crc32(part.tobytes()), len(ids), key))
                cols = list(zip(*rows)) or [()] * 6
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "row_key")
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=list(names))

    slim = docs.select(
        F.col(id_col).cast("long").alias("_id"),
        F.col(text_col).alias("_text"),
        F.xxhash64(F.col(id_col), F.length(text_col)).alias("_key"),
    )
    return slim.mapInArrow(pieces, _PIECES)


def packing_plan(histogram: dict[int, int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[tuple[int, int]], int]]:
    """Window kinds as (tier, [(piece length, pieces of it), ...], number of such windows).

    Greedy on counts: a window opens with the longest length left in its tier and takes the longest
    length that fits its gap, again and again; the kind is used as often as the counts allow, which
    uses up one length at least, so there are no more kinds than lengths for each pass over a tier.
    """
    from bisect import bisect_right

    left = {k: n for k, n in histogram.items() if n > 0}
    lengths = sorted(left)
    longest = tiers[-1]
    plan: list[tuple[int, list[tuple[int, int]], int]] = []

    def fill(first: int, size: int) -> list[tuple[int, int]]:
        kind, gap = [(first, 1)], size - first
        spent = {first: 1}
        while gap:
            i = bisect_right(lengths, gap) - 1
            while i >= 0 and left[lengths[i]] <= spent.get(lengths[i], 0):
                i -= 1
            if i < 0:
                break
            k = lengths[i]
            n = min(gap // k, left[k] - spent.get(k, 0))
            spent[k] = spent.get(k, 0) + n
            kind.append((k, n))
            gap -= k * n
        return kind

    def use(tier: int, kind: list[tuple[int, int]]) -> None:
        need: dict[int, int] = {}
        for k, n in kind:
            need[k] = need.get(k, 0) + n
        times = min(left[k] // n for k, n in need.items())
        plan.append((tier, sorted(need.items(), reverse=True), times))
        for k, n in need.items():
            left[k] -= n * times
            if not left[k]:
                lengths.remove(k)

    # The long tier's own pieces open its windows.
    for first in [k for k in reversed(lengths) if k > tiers[-2]]:
        while left[first]:
            use(longest, fill(first, longest))
    # Shorter tiers: windows that come out exactly full.
    for tier, low in zip(tiers[-2::-1], [*tiers[-3::-1], 0]):
        for first in [k for k in reversed(lengths) if low < k <= tier]:
            while left[first]:
                kind = fill(first, tier)
                if sum(k * n for k, n in kind) != tier:
                    break
                use(tier, kind)
    # The rest shares long windows.
    while lengths:
        use(longest, fill(lengths[-1], longest))
    return plan


_SLOTS = "s_length int, first long, stop long, each int, window long, at int, tier int, tier_window long"


def _plan_slots(plan) -> list[tuple[int, ...]]:
    """Where the ranks of a length go, as rows of ``_SLOTS``; windows are numbered, also within their tier."""
    taken: dict[int, int] = {}
    in_tier: dict[int, int] = {}
    slots, window = [], 0
    for tier, kind, times in plan:
        offset = 0
        for k, n in kind:
            first = taken.get(k, 0)
            slots.append((k, first, first + n * times, n, window, offset, tier, in_tier.get(tier, 0)))
            taken[k] = first + n * times
            offset += k * n
        window += times
        in_tier[tier] = in_tier.get(tier, 0) + times
    return slots


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = 1 << 19,
    id_col: str = "doc_id",
    text_col: str = "text",
    buckets: int = 64,
) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group.

    A sequence's pieces lie without gaps from offset 0; ``tier`` is its window. ``step_group``
    deals the windows of each tier evenly over steps of about ``step_tokens`` tokens, so steps
    hold the same number of windows of each length, give or take one.

    Null text is the empty text and has one piece, the end id. Repeated rows are packed each.
    An empty table gives no rows. Extra columns are ignored. ``buckets`` splits the ranking of
    the pieces of one length, so a length that a third of all pieces share is no one task's.
    """
    spark = docs.sparkSession
    pieces = materialise(tokenised_pieces(docs, tokenizer_path, tiers[-1], id_col, text_col), "pack-pieces")
    # At most one row per length up to the longest window: bounded by the tiers, not by the input.
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = packing_plan(histogram, tiers)
    windows = {t: sum(times for tier, _, times in plan if tier == t) for t in tiers}
    steps = max(1, -(-sum(t * n for t, n in windows.items()) // step_tokens))
    # One row per window kind and length; kinds are bounded by tiers times lengths, so this is broadcast.
    slots = F.broadcast(spark.createDataFrame(_plan_slots(plan), _SLOTS))
    ranked = split_rank(
        pieces.withColumn("_b", hash_bucket(F.struct("row_key", "start"), buckets)),
        ["length"],
        "_b",
        [F.col("row_key"), F.col("doc_id"), F.col("start"), F.col("ids_crc32")],
        "rank",
    )
    on = (F.col("length") == F.col("s_length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("stop"))
    nth = F.col("rank") - F.col("first")
    use = F.floor(nth / F.col("each"))
    return ranked.join(slots, on).select(
        "doc_id",
        "start",
        F.col("length").cast("long").alias("length"),
        "ids_crc32",
        "doc_tokens",
        (F.col("window") + use).cast("long").alias("sequence_id"),
        (F.col("at") + F.pmod(nth, F.col("each")) * F.col("length")).cast("long").alias("offset"),
        "tier",
        F.pmod(F.col("tier_window") + use, F.lit(steps)).cast("long").alias("step_group"),
    )
