"""Alignment of two tokenizers' tokens by divide and conquer at shared cuts.

Both tokenizers cut the bytes of blank + text. Offsets where both have a token's end are shared
cuts; between two of them lies a group of tokens of either side. ``align`` finds the groups: it
looks for a shared cut near the middle of an interval, outward from there, each end of one side by
bisection among the other's; both halves follow, and an interval without a shared cut is a group. All
intervals of a level, of many texts, are halved together.

Documents are cut first where both tokenizers certainly end a token (before a blank that follows a
non-blank, and between a word and a mark behind it, as no piece of B joins these); what lies between,
a unit, is encoded and aligned once in a worker and kept at hand.

Counts over the corpus (in how many documents a pair of ids is linked) take one shuffle of one
row per pair and block: a block is what one task meets until it has a bounded number of units, so
a pair costs a row a block however often it occurs, and no document's pairs are shuffled. The
totals return to the blocks that asked for them, where documents are folded as a stream.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabcast.llm.common import materialise

#: A block ends after so many different units, or units in all.
BLOCK_UNITS = 300_000
BLOCK_REFERENCES = 6_000_000
#: Units and numbered pairs after which a worker begins anew with the next block; longer units are not kept for other texts.
UNITS_KEPT = 600_000
PAIRS_KEPT = 1_000_000
LONGEST = 64
#: Texts that a task takes as Python strings at a time, and units in one row of a written block.
TOGETHER = 128
UNITS_A_ROW = 4096

PAIRS, UNITS, DOCUMENTS = 0, 1, 2
_STAGE = (
    "block string, kind int, at long, pair long, n long, numbers binary, sizes binary, flat binary, links binary, doc_id long, "
    "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
)
_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

_LETTERS, _MARKS = "a-zA-ZÀ-ÖØ-öø-ÿ", ",.;:!?"
# What lies between a blank that follows a non-blank and the next one; the second pattern also cuts a word from a mark behind it.
_units = re.compile(r"\s*\S+(?:[^\S ]\s*\S*)*|\s+").findall
_finer_units = re.compile(rf" [{_LETTERS}]+(?=[{_MARKS}])|[{_MARKS}](?= |$)|\s*\S+(?:[^\S ]\s*\S*)*|\s+").findall


def align_all(a_ends: np.ndarray, b_ends: np.ndarray, a_begin: np.ndarray, b_begin: np.ndarray) -> tuple[np.ndarray, ...]:
    """Groups (first a, end a, first b, end b), in order, of many texts that lie one behind the other.

    The ends rise over all texts; text i has the tokens from a_begin[i] to a_begin[i + 1] of one side, and from
    b_begin[i] to b_begin[i + 1] of the other, at least one of each, and the last ends agree. All texts' intervals
    are halved level by level; every end of ``a`` is looked up once at most, so it takes n log n steps.
    """
    # Intervals of tokens, and the range of a's ends in them that may be shared and were not looked up yet.
    a0, a1, b0, b1 = a_begin[:-1], a_begin[1:], b_begin[:-1], b_begin[1:]
    low, high = a0, a1 - 1
    groups = []
    while len(a0):
        left = np.minimum(np.maximum((a0 + a1 - 1) // 2, low), high - 1)
        right = left + 1
        cut, at = np.full(len(a0), -1), np.zeros(len(a0), dtype=np.int64)
        todo = np.flatnonzero((low < high) & (b1 - b0 > 1))
        while len(todo):
            for side, step in ((left, -1), (right, 1)):
                mine = todo[(cut[todo] < 0) & ((side[todo] >= low[todo]) if step < 0 else (side[todo] < high[todo]))]
                k = side[mine]
                j = np.searchsorted(b_ends, a_ends[k])
                shared = b_ends[j] == a_ends[k]
                cut[mine[shared]], at[mine[shared]] = k[shared], j[shared]
                side[mine] += step
            todo = todo[(cut[todo] < 0) & ((left[todo] >= low[todo]) | (right[todo] < high[todo]))]
        whole, halved = cut < 0, cut >= 0
        groups.append((a0[whole], a1[whole], b0[whole], b1[whole]))
        k, j = cut[halved], at[halved]
        halves = [(a0[halved], k + 1), (k + 1, a1[halved]), (b0[halved], j + 1), (j + 1, b1[halved]), (low[halved], right[halved]), (left[halved] + 1, high[halved])]
        a0, a1 = np.concatenate([halves[0][0], halves[1][0]]), np.concatenate([halves[0][1], halves[1][1]])
        b0, b1 = np.concatenate([halves[2][0], halves[3][0]]), np.concatenate([halves[2][1], halves[3][1]])
        low, high = np.concatenate(halves[4]), np.concatenate(halves[5])
    a0, a1, b0, b1 = (np.concatenate(x) for x in zip(*groups)) if groups else (np.zeros(0, dtype=np.int64),) * 4
    order = np.argsort(a0, kind="stable")
    return a0[order], a1[order], b0[order], b1[order]


def align(a_ends: list[int], b_ends: list[int]) -> list[tuple[int, int, int, int]]:
    """``align_all`` of one text; without tokens there are no groups."""
    if not len(a_ends):
        return []
    begin = np.array([0, len(a_ends)]), np.array([0, len(b_ends)])
    return list(zip(*(x.tolist() for x in align_all(np.asarray(a_ends), np.asarray(b_ends), *begin))))


class Grown:
    """A numpy array that rows are added to."""

    def __init__(self, kind, width: int = 0):
        self._all = np.zeros((1024, width) if width else 1024, dtype=kind)
        self.n = 0

    def add(self, rows: np.ndarray) -> None:
        if self.n + len(rows) > len(self._all):
            more = np.zeros((max(2 * len(self._all), self.n + len(rows)), *self._all.shape[1:]), dtype=self._all.dtype)
            more[: self.n] = self._all[: self.n]
            self._all = more
        self._all[self.n : self.n + len(rows)] = rows
        self.n += len(rows)

    @property
    def rows(self) -> np.ndarray:
        return self._all[: self.n]


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers start[i] to start[i] + size[i] − 1, one range after the other."""
    return np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)


def links_of(a_ids: list[int], b_ids: list[int]) -> tuple[list[int], list[int]]:
    """The pairs (a id << 32) + b id of a group, and how many links each stands for: a long group repeats few ids, so they are counted."""
    of_a, of_b = Counter(a_ids), Counter(b_ids)
    return [(a << 32) + b for a in of_a for b in of_b], [x * y for x in of_a.values() for y in of_b.values()]


class Units:
    """Units that a worker has met, numbered: their sizes (tokens of A and B, groups, links), numbered pairs, and groups as text."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.text: list[str] = []
        #: The first size of a unit that A or B does not spell is −1.
        self.sizes = Grown(np.int64, 4)
        self.begin, self.pairs, self.links = Grown(np.int64), Grown(np.int32), Grown(np.int64)
        self.begin.add(np.zeros(1, dtype=np.int64))
        self.pair_number: dict[int, int] = {}
        self.pair_text: list[str] = []

    def pair_numbers(self, keys: np.ndarray) -> np.ndarray:
        found, at = np.unique(keys, return_inverse=True)
        out = np.empty(len(found), dtype=np.int32)
        for i, key in enumerate(found.tolist()):
            n = self.pair_number.get(key)
            if n is None:
                n = self.pair_number[key] = len(self.pair_text)
                self.pair_text.append(f"{key >> 32}|{key & 0xFFFFFFFF}")
            out[i] = n
        return out[at]

    def add(self, a_ids: list[list[int]], b_ids: list[list[int]], a_size: np.ndarray, b_size: np.ndarray) -> None:
        """Align units, given by their tokens; both sides' tokens spell the same bytes."""
        n_a, n_b = (np.fromiter(map(len, x), dtype=np.int64, count=len(x)) for x in (a_ids, b_ids))
        a = np.fromiter(chain.from_iterable(a_ids), dtype=np.int64, count=n_a.sum())
        b = np.fromiter(chain.from_iterable(b_ids), dtype=np.int64, count=n_b.sum())
        a_begin, b_begin = (np.concatenate([[0], np.cumsum(n)]) for n in (n_a, n_b))
        a0, a1, b0, b1 = align_all(np.cumsum(a_size[a]), np.cumsum(b_size[b]), a_begin, b_begin)
        of = np.searchsorted(a_begin, a0, side="right") - 1
        count, single = np.ones(len(a0), dtype=np.int64), (a1 - a0 == 1) & (b1 - b0 == 1)
        longer = {int(g): links_of(a[a0[g] : a1[g]].tolist(), b[b0[g] : b1[g]].tolist()) for g in np.flatnonzero(~single)}
        count[list(longer)] = [len(x) for x, _ in longer.values()]
        start = np.cumsum(count) - count
        keys, links = np.zeros(count.sum(), dtype=np.int64), np.ones(count.sum(), dtype=np.int64)
        keys[start[single]] = (a[a0[single]] << 32) + b[b0[single]]
        for g, (pairs, times) in longer.items():
            keys[start[g] : start[g] + len(pairs)], links[start[g] : start[g] + len(pairs)] = pairs, times
        numbers = self.pair_numbers(keys)
        text = list(map(self.pair_text.__getitem__, numbers[start].tolist()))
        for g in longer:
            text[g] = f"{','.join(map(str, a[a0[g] : a1[g]].tolist()))}|{','.join(map(str, b[b0[g] : b1[g]].tolist()))}"
        n_groups = np.bincount(of, minlength=len(n_a))
        end = np.cumsum(n_groups)
        self.text += [";".join(text[i:j]) for i, j in zip((end - n_groups).tolist(), end.tolist())]
        n_links = np.bincount(of, (a1 - a0) * (b1 - b0), minlength=len(n_a)).astype(np.int64)
        self.sizes.add(np.stack([n_a, n_b, n_groups, n_links], axis=1))
        self.begin.add(self.begin.rows[-1] + np.cumsum(np.bincount(of, count, minlength=len(n_a)).astype(np.int64)))
        self.pairs.add(numbers)
        self.links.add(links)

    def add_bad(self, n: int) -> None:
        self.text += [""] * n
        self.sizes.add(np.tile(np.array([-1, 0, 0, 0]), (n, 1)))
        self.begin.add(np.full(n, self.begin.rows[-1]))

    def pairs_at(self, units: np.ndarray) -> np.ndarray:
        begin = self.begin.rows
        return _ranges(begin[units], begin[units + 1] - begin[units])


class Aligner:
    """Units of texts, aligned for a byte-level BPE tokenizer (A, a .json file) and a sentencepiece BPE model (B)."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE" or spec.get("normalizer") or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
            raise ValueError(f"{path_a} is no byte-level BPE tokenizer without normalizer")
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        # Byte-level BPE spells printable bytes as themselves and the rest as code points from 256 on.
        plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        rest = iter(range(256, 512))
        byte_of = {(chr(b) if b in plain else chr(next(rest))): b for b in range(256)}
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        if not vocabulary.keys() >= byte_of.keys():
            raise ValueError(f"{path_a} cannot spell all bytes")
        # Each of its characters stands for a byte, and every byte has one: A's tokens spell any text.
        self.a_size = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for t, i in vocabulary.items():
            self.a_size[i] = len(t)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.b_size = np.array(list(map(len, self.b_bytes)))
        # Where no piece has a blank after another character, no merge of B crosses a unit's begin.
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        letter_mark = re.compile(rf"[{_LETTERS}][{_MARKS}]").search
        self.finer = self.cuts and not any(letter_mark(p) for i, p in enumerate(pieces) if not self.b.is_byte(i))
        self.blank, self.letter = self.b.piece_to_id("▁"), "a"
        self.units = Units()

    def units_of(self, text: str) -> list[str]:
        return _finer_units(" " + text) if self.finer else _units(" " + text) if self.cuts else [" " + text]

    def forget(self) -> None:
        """Begin anew once what is kept at hand is too much."""
        if len(self.units.text) > UNITS_KEPT or len(self.units.pair_text) > PAIRS_KEPT:
            self.units = Units()

    def learn(self, new: list[str]) -> None:
        """Number and align new units, in their order."""
        known = self.units
        first = len(known.text)
        # B puts the blank before a text itself, but not before the empty text. A unit that begins with
        # a mark is encoded behind a letter, whose token is dropped.
        b_ids = self.b.encode([u[1:] if u[0] == " " else self.letter + u for u in new], num_threads=1)
        b_ids = [(b or [self.blank]) if u[0] == " " else b[1:] for u, b in zip(new, b_ids)]
        a_ids = [e.ids for e in self.a.encode_batch_fast(new, add_special_tokens=False)]
        spell = self.b_bytes.__getitem__
        if b"".join(map(spell, chain.from_iterable(b_ids))) == "".join(new).encode() and self._sizes_agree(a_ids, b_ids):
            known.add(a_ids, b_ids, self.a_size, self.b_size)
        else:
            for u, a, b in zip(new, a_ids, b_ids):
                if b"".join(map(spell, b)) == u.encode():
                    known.add([a], [b], self.a_size, self.b_size)
                else:
                    known.add_bad(1)
        known.number.update((u, first + i) for i, u in enumerate(new) if len(u) <= LONGEST)

    def _sizes_agree(self, a_ids: list[list[int]], b_ids: list[list[int]]) -> bool:
        """Whether each unit's tokens of A and B spell as many bytes."""
        sums = []
        for ids, size in ((a_ids, self.a_size), (b_ids, self.b_size)):
            n = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
            ends = np.concatenate([[0], np.cumsum(size[np.fromiter(chain.from_iterable(ids), dtype=np.int64, count=n.sum())])])
            sums.append(ends[np.cumsum(n)])
        return bool((sums[0] == sums[1]).all())


_aligners: dict[tuple[str, str], Aligner] = {}


def _aligner(path_a: str, path_b: str) -> Aligner:
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(path_a, path_b)
    return _aligners[path_a, path_b]


class _Block:
    """Which of a worker's units a task has met since it began the block, and in how many documents each pair is linked."""

    def __init__(self, units: Units):
        self.name = uuid.uuid4().hex
        self.units = units
        self.met = Grown(np.bool_)
        self.documents = Grown(np.int64)
        self.n_met = self.references = 0

    @property
    def full(self) -> bool:
        return self.n_met >= BLOCK_UNITS or self.references >= BLOCK_REFERENCES

    def count(self, numbers: np.ndarray) -> None:
        """Count a document of these units."""
        for grown, n in ((self.met, len(self.units.text)), (self.documents, len(self.units.pair_text))):
            if grown.n < n:
                grown.add(np.zeros(n - grown.n, dtype=grown.rows.dtype))
        mine = np.unique(numbers)
        self.n_met += int((~self.met.rows[mine]).sum())
        self.met.rows[mine] = True
        self.documents.rows[np.unique(self.units.pairs.rows[self.units.pairs_at(mine)])] += 1
        self.references += len(numbers)


def _rows(block: str, kind: int, rows: int, **columns):
    """An Arrow batch of the written stage; columns that are not given are null."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in _STAGE.split(", ")]
    given = {"block": pa.array([block] * rows, pa.string()), "kind": pa.array([kind] * rows, pa.int32())}
    arrays = [given[c] if c in given else pa.array(columns[c], kinds[k]) if c in columns else pa.nulls(rows, kinds[k]) for c, k in fields]
    return pa.RecordBatch.from_arrays(arrays, names=[c for c, _ in fields])


def _close(block: _Block) -> Iterator:
    """The rows of a block's pairs and units; units go by their numbers in the worker, pairs by their places in the block."""
    known = block.units
    met = np.flatnonzero(block.documents.rows)
    place = np.zeros(len(known.pair_text), dtype="<i4")
    place[met] = np.arange(len(met))
    keys = np.fromiter(known.pair_number, dtype=np.int64, count=len(known.pair_number))
    for at in range(0, len(met), 50_000):
        part = met[at : at + 50_000]
        yield _rows(block.name, PAIRS, len(part), at=np.arange(at, at + len(part)), pair=keys[part], n=block.documents.rows[part])
    units = np.flatnonzero(block.met.rows)
    ats, numbers, sizes, flats, links = [], [], [], [], []
    for at in range(0, len(units), UNITS_A_ROW):
        part = units[at : at + UNITS_A_ROW]
        pairs = known.pairs_at(part)
        ats.append(at)
        numbers.append(part.astype("<i4").tobytes())
        sizes.append((known.begin.rows[part + 1] - known.begin.rows[part]).astype("<i4").tobytes())
        flats.append(place[known.pairs.rows[pairs]].tobytes())
        links.append(known.links.rows[pairs].astype("<i8").tobytes())
    if ats:
        yield _rows(block.name, UNITS, len(ats), at=ats, numbers=numbers, sizes=sizes, flat=flats, links=links)


def _documents(block: _Block, aligner: Aligner, rows: list[tuple]):
    """The rows of documents (id, text); their units and links are counted in the block."""
    known = aligner.units
    texts = [aligner.units_of(t) if t else [] for _, t in rows]
    new = list(dict.fromkeys(u for units in texts for u in units if u not in known.number))
    if new:
        first = len(known.text)
        aligner.learn(new)
        # Long units have a number in this batch only.
        long = {u: first + i for i, u in enumerate(new) if len(u) > LONGEST}
    else:
        long = {}
    get, spelt = known.number.get, known.sizes.rows[:, 0] >= 0
    ids, flats, counts, digests = [], [], [], []
    for (doc_id, _), units in zip(rows, texts):
        ids.append(doc_id)
        numbers = [n if (n := get(u)) is not None else long[u] for u in units]
        at = np.array(numbers, dtype=np.int64)
        if not units or not spelt[at].all():
            flats.append(b"")
            counts.append((0, 0, 0, 0))
            digests.append("")
            continue
        block.count(at)
        flats.append(at.astype("<i4").tobytes())
        counts.append(known.sizes.rows[at].sum(axis=0).tolist())
        digests.append(hashlib.sha256(";".join([known.text[n] for n in numbers]).encode()).hexdigest())
    n_a, n_b, n_groups, n_links = zip(*counts)
    return _rows(block.name, DOCUMENTS, len(ids), doc_id=ids, flat=flats, n_a=n_a, n_b=n_b, n_groups=n_groups, n_links=n_links, groups_sha256=digests)


def _fold(batches: Iterator) -> Iterator:
    """Rows sorted by (block, kind, at), with the pairs' totals and whether they are their A id's best: one row per document."""
    names = [f.split()[0] for f in _RESULT.split(", ")]
    block = None
    for whole in batches:
        # A part of the batch at a time, as its binary columns become Python values.
        for first in range(0, whole.num_rows, 1000):
            batch = whole.slice(first, 1000)
            out: list[tuple] = []
            cols = [batch[c].to_pylist() for c in ("block", "kind", "n", "best", "numbers", "sizes", "flat", "links", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
            for name, kind, n, top, numbers, sizes, flat, links, doc_id, n_a, n_b, n_groups, n_links, digest in zip(*cols):
                if name != block:
                    block, totals, units = name, Grown(np.int64, 2), Grown(np.int64, 2)
                if kind == PAIRS:
                    totals.add(np.array([[top, n]]))
                elif kind == UNITS:
                    numbers, sizes = np.frombuffer(numbers, "<i4"), np.frombuffer(sizes, "<i4")
                    flat, links = np.frombuffer(flat, "<i4"), np.frombuffer(links, "<i8")
                    # A unit has one token of either side at least, so it has a link.
                    sums = np.add.reduceat(totals.rows[flat] * links[:, None], np.cumsum(sizes) - sizes, axis=0)
                    if numbers[-1] >= units.n:
                        units.add(np.zeros((int(numbers[-1]) + 1 - units.n, 2), dtype=np.int64))
                    units.rows[numbers] = sums
                else:
                    n_best, count_sum = units.rows[np.frombuffer(flat, "<i4")].sum(axis=0).tolist()
                    out.append((doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, digest))
            cols = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if k == "groups_sha256" else pa.int64()) for c, k in zip(cols, names)], names=names)


def align_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: tokens of A and B, groups, links, and how common its links are in the corpus.

    A encodes blank + text, B the text, to which it adds the blank; strings of special tokens are
    plain text. Returns doc_id, n_a, n_b, n_groups, n_links (pairs of tokens that share a group),
    n_best (links whose pair of ids is linked in as many documents as any pair of its A id),
    count_sum (that number summed over the links) and groups_sha256 (of ``a1,a2|b1;a3|b2,b3``).

    Null and empty texts, and texts whose tokens do not spell blank + text, have no tokens: zeros, and
    the empty string for the digest; they link nothing. Rows that repeat, or have null ids, are documents
    each. An empty table gives no rows. Extra columns are ignored, whatever their names.
    """

    def encode(batches: Iterator) -> Iterator:
        aligner = _aligner(path_a, path_b)
        aligner.forget()
        block = _Block(aligner.units)
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                yield _documents(block, aligner, list(zip(part["doc_id"].to_pylist(), part["text"].to_pylist())))
                if block.full:
                    yield from _close(block)
                    aligner.forget()
                    block = _Block(aligner.units)
        yield from _close(block)

    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    stage = materialise(slim.mapInArrow(encode, _STAGE), "tokenizer-alignment")
    pairs = stage.where(F.col("kind") == PAIRS).select("block", "at", "pair", "n")
    totals = pairs.groupBy("pair").agg(F.sum("n").alias("n"))
    a_id = F.shiftright("pair", 32)
    best = totals.groupBy(a_id.alias("a_id")).agg(F.max("n").alias("most"))
    counted = totals.withColumn("a_id", a_id).join(best, "a_id").select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))
    kept = ["numbers", "sizes", "flat", "links", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    back = pairs.drop("n").join(counted, "pair").select("block", F.lit(PAIRS).alias("kind"), "at", "n", "best", *(F.lit(None).cast(stage.schema[c].dataType).alias(c) for c in kept))
    rest = stage.where(F.col("kind") != PAIRS).select("block", "kind", "at", "n", F.lit(None).cast("long").alias("best"), *kept)
    dealt = back.unionByName(rest).repartition("block").sortWithinPartitions("block", "kind", "at")
    return dealt.mapInArrow(_fold, _RESULT)
