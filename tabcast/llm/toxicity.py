"""Toxicity by the nearest labelled examples.

A bounded sample of labelled texts gives the examples and their whole vocabulary (words, and
beginnings of long words that lean beyond chance). Every text is tokenised once and written as the
numbers and counts of its terms; document frequencies are counted over all of these, and they are
what is scored. A text is a TF-IDF vector in which a term weighs the more the more it leans to toxic or
to clean examples; its nearest examples by exact cosine are found in a block-max inverted index, and their
votes, weighted by nearness and calibrated on the examples themselves, give the score. The neighbours are
the evidence.

The driver holds arrays of bounded size only: the vocabulary, the examples' vectors and a histogram of
their votes. The lookup table of terms and the index are built in the tasks.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabcast.llm.common import materialise

#: At most so many labelled rows, those of smallest hash, are examples.
MAX_EXAMPLES = 16_000
NEIGHBOURS = 15
BLOCK = 64
THRESHOLD = 0.7
#: Lengths of the word beginnings that are terms beside whole words.
BEGINS = (5, 7)
#: Examples are taken, smallest hash first, until they have so many terms in all, so that the index has a bounded size.
MAX_POSTINGS = 8_000_000
#: Steps of the histogram of votes from which the sigmoid is fitted.
VOTE_STEPS = 1000
#: A term in this share of the examples is kept as a column of the blocks instead of a posting list.
COMMON = 0.1
#: Texts that are searched for together.
TOGETHER = 64
#: The vote of no neighbour at all.
NO_VOTE = 0.2
_words = re.compile(r"[^\W\d_]+").findall


def terms_of(text: str) -> Counter:
    """Term counts of a text: its words of letters, lower-cased, and ``abcde*`` for beginnings of longer words."""
    c = Counter(_words(text.lower()))
    for k in BEGINS:
        for w, n in [x for x in c.items() if len(x[0]) > k and x[0].isalpha()]:
            c[f"{w[:k]}*"] += n
    return c


class Terms:
    """The terms of a text that are in the vocabulary, without counting all others."""

    def __init__(self, terms: dict[str, int]):
        self.whole = {t: i for t, i in terms.items() if not t.endswith("*")}
        self.begins = {k: {t[:k]: i for t, i in terms.items() if t.endswith("*") and len(t) == k + 1} for k in BEGINS}

    def __call__(self, text: str) -> tuple:
        """(numbers of the terms, their counts), two arrays, by number."""
        import numpy as np

        found, counts = [], []
        for w, n in Counter(_words(text.lower())).items():
            if w in self.whole:
                found.append(self.whole[w])
                counts.append(n)
            for k, begin in self.begins.items():
                if len(w) > k and w[:k] in begin:
                    found.append(begin[w[:k]])
                    counts.append(n)
        terms, at = np.unique(np.array(found, dtype=np.int64), return_inverse=True)
        return terms, np.bincount(at, counts, minlength=len(terms))


def leans(n1, n0, all1: int, all0: int):
    """Log-likelihood ratios of terms that are in n1 of all1 toxic and n0 of all0 clean texts, whichever they lean to."""
    import numpy as np

    n1, n0 = np.asarray(n1, dtype=float), np.asarray(n0, dtype=float)
    p, total = (n1 + n0) / max(all1 + all0, 1), np.zeros(len(n1))
    for n, of in ((n1, all1), (n0, all0)):
        for k, q in ((n, p), (of - n, 1 - p)):
            some = k > 0
            total[some] += 2 * k[some] * np.log(k[some] / (of * q[some]))
    return np.maximum(total, 0.0)


def _pair(vector) -> tuple:
    """A vector as the arrays of its terms and weights."""
    import numpy as np

    if not isinstance(vector, dict):
        return vector
    return np.fromiter(vector.keys(), dtype=np.int64, count=len(vector)), np.fromiter(vector.values(), dtype=float, count=len(vector))


def _at_least(score, blocks: int, k: int):
    """For each row a number that k entries reach, from the largest of each block; and these largest."""
    import numpy as np

    most = score.reshape(len(score), blocks, -1).max(axis=2)
    return (np.partition(most, blocks - k, axis=1)[:, blocks - k] if blocks >= k else np.full(len(score), -np.inf)), most


class BlockMaxIndex:
    """Examples as unit vectors, in blocks, with each term's largest weight in each block.

    Terms in few examples have posting lists, cut at the blocks; the common ones are columns of the
    blocks. The products of a query's weights with the maxima bound every block's best cosine. The
    two blocks of the largest bounds are summed first; what k of their examples reach is a
    threshold, and blocks whose bound is below it are never summed, neither their postings nor their
    columns. The others are summed in full, so the result is exact.
    """

    def __init__(self, vectors: list, ids, block: int = BLOCK):
        vectors = [_pair(v) for v in vectors]
        self.block, self.blocks = block, -(-len(ids) // block)
        size = np.array([len(t) for t, _ in vectors], dtype=np.int64)
        term, weight = np.concatenate([t for t, _ in vectors]).astype(np.int32), np.concatenate([w for _, w in vectors])
        # Examples that share their strongest term lie together, so the blocks' bounds are tight.
        strongest = [int(t[np.argmax(w)]) if len(t) else -1 for t, w in vectors]
        self.row = np.array(sorted(range(len(ids)), key=lambda i: (strongest[i], ids[i])), dtype=np.int64)
        self.ids = np.array([ids[i] for i in self.row], dtype=np.int64)
        self.place = np.empty(len(ids), dtype=np.int64)
        self.place[self.row] = np.arange(len(ids))
        at = np.repeat(self.place, size).astype(np.int32)
        df = np.bincount(term)
        common = np.flatnonzero(df > max(COMMON * len(ids), 1))
        self.column = np.full(len(df), -1, dtype=np.int32)
        self.column[common] = np.arange(len(common))
        column = self.column[term]
        dense = np.zeros((self.blocks * block, len(common)))
        dense[at[column >= 0], column[column >= 0]] = weight[column >= 0]
        self.dense = dense.reshape(self.blocks, block, len(common))
        self.most = self.dense.max(axis=1)
        rare = np.flatnonzero(column < 0)
        rare = rare[np.lexsort((at[rare], term[rare]))]
        self.at, self.weight, term = at[rare], weight[rare], term[rare]
        # A part of a posting list: the postings of one term in one block.
        of = term.astype(np.int64) * self.blocks + self.at // block
        self.start = np.flatnonzero(np.diff(of, prepend=-1))
        self.size = np.diff(self.start, append=len(of))
        self.part_block = self.at[self.start] // block
        self.part_most = np.maximum.reduceat(self.weight, self.start) if len(of) else np.zeros(0)
        self.begin = np.concatenate([[0], np.cumsum(np.bincount(term[self.start], minlength=len(df)))])
        #: Blocks that were summed, and blocks in all, over the queries so far.
        self.visited, self.asked = 0, 0

    def nearest(self, query, k: int = NEIGHBOURS, but: int = -1) -> list[tuple[int, float]]:
        """The k (example row, cosine) of largest cosine above 0, ties to smaller ids; ``but`` is left out."""
        return self.nearest_of([query], k, [but])[0]

    def nearest_of(self, queries: list, k: int = NEIGHBOURS, buts: list[int] | None = None) -> list[list[tuple[int, float]]]:
        """``nearest`` of each query; a query is a dict of weights or the arrays of its terms and weights."""
        found = []
        for first in range(0, len(queries), TOGETHER):
            found += self._nearest_of(queries[first : first + TOGETHER], k, buts[first : first + TOGETHER] if buts is not None else None)
        return found

    def _nearest_of(self, queries: list, k: int, buts: list[int] | None) -> list[list[tuple[int, float]]]:
        n, blocks, block = len(self.ids), self.blocks, self.block
        common, parts = np.zeros((len(queries), self.dense.shape[2])), []
        bound = np.zeros((len(queries), blocks))
        for q, query in enumerate(queries):
            term, w = _pair(query)
            known = term < len(self.column)
            term, w = term[known], w[known]
            column = self.column[term]
            common[q, column[column >= 0]] = w[column >= 0]
            term, w = term[column < 0], w[column < 0]
            part = _ranges(self.begin[term], self.begin[term + 1] - self.begin[term])
            weight = np.repeat(w, self.begin[term + 1] - self.begin[term])
            of = self.part_block[part]
            bound[q] = np.bincount(of, weight * self.part_most[part], minlength=blocks)
            parts.append((part, weight, of))
        bound += common @ self.most.T
        score = np.full((len(queries), blocks, block), -np.inf)
        visit = np.zeros(bound.shape, dtype=bool)
        np.put_along_axis(visit, np.argsort(-bound, axis=1)[:, : max(2, -(-k // block) + 1)], True, axis=1)
        self._sum(score, visit, parts, common, buts)
        least = _kth(score.reshape(len(queries), -1), k)
        more = (bound >= least[:, None] - 1e-9) & ~visit
        self._sum(score, more, parts, common, buts)
        self.visited += int(visit.sum() + more.sum())
        self.asked += visit.size
        score = score.reshape(len(queries), -1)
        least = _kth(score, k)
        found = []
        for q in range(len(queries)):
            best = np.flatnonzero(score[q, :n] >= max(least[q] - 1e-9, 1e-12))
            # Equal vectors may differ in the last digits of their sums.
            best = best[np.lexsort((self.ids[best], -score[q, best].round(12)))[:k]]
            found.append([(int(self.row[i]), float(score[q, i])) for i in best])
        return found

    def _sum(self, score, visit, parts, common, buts) -> None:
        """Cosines of the examples of the blocks to ``visit``, written into ``score``."""
        for b in np.flatnonzero(visit.any(axis=0)):
            score[visit[:, b], b] = common[visit[:, b]] @ self.dense[b].T
        for q, (part, weight, of) in enumerate(parts):
            if not visit[q].any():
                continue
            inside = visit[q][of]
            part, weight = part[inside], weight[inside]
            size = self.size[part]
            place = _ranges(self.start[part], size)
            sums = np.bincount(self.at[place], self.weight[place] * np.repeat(weight, size), minlength=self.blocks * self.block)
            score[q, visit[q]] += sums.reshape(self.blocks, self.block)[visit[q]]
            if buts is not None and buts[q] >= 0:
                score[q, self.place[buts[q]] // self.block, self.place[buts[q]] % self.block] = -np.inf
        score.reshape(len(score), -1)[:, len(self.ids) :] = -np.inf


def _ranges(start, size):
    """The numbers start[i] to start[i] + size[i] − 1, one range after the other."""
    return np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)


def _kth(score, k: int):
    """The k-th largest of each row; −inf where there are fewer."""
    return np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k] if score.shape[1] >= k else np.full(len(score), -np.inf)


def _pack(values) -> bytes:
    """Whole numbers from 0 on, in two bytes each where they fit, in four where not; the first byte says which."""
    return b"\2" + values.astype("<u2").tobytes() if not len(values) or values.max() < 1 << 16 else b"\4" + values.astype("<u4").tobytes()


def _unpack(data: bytes):
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def pack_terms(terms, counts) -> tuple[bytes, bytes]:
    """Rising numbers of terms, as steps, and their counts."""
    return _pack(np.diff(terms, prepend=0)), _pack(counts)


def unpack_terms(terms: bytes, counts: bytes) -> tuple:
    return np.cumsum(_unpack(terms)), _unpack(counts)


class Model:
    """What scoring needs, as arrays: terms, their weights, the examples' vectors, and the calibration."""

    def __init__(self, terms: pa.Array, weights, ids: list[int], labels: list[int], vectors: list[tuple[bytes, bytes]]):
        self.terms, self.weights = terms, weights
        bare = [y for y, (t, _) in zip(labels, vectors) if len(t) == 1]
        #: Score of a text without any word of the vocabulary: the share of toxic texts among such examples.
        self.bare = (sum(bare) + 0.02) / (len(bare) + 2)
        keep = [i for i, (t, _) in enumerate(vectors) if len(t) > 1]
        self.ids, self.labels = [ids[i] for i in keep], [labels[i] for i in keep]
        self.vectors = [vectors[i] for i in keep]
        self.slope, self.shift = 8.0, -4.0


class Scorer:
    """A ``Model`` with its index, built in a task."""

    def __init__(self, model: Model):
        self.model = model
        self.index = BlockMaxIndex([self.known(i) for i in range(len(model.ids))], model.ids) if model.ids else None

    def known(self, i: int) -> tuple:
        """The vector of an example."""
        return self.vector(*unpack_terms(*self.model.vectors[i]))

    def vector(self, terms, counts) -> tuple:
        w = (1 + np.log(counts)) * self.model.weights[terms]
        return terms, w / max(math.sqrt(w @ w), 1e-300)

    def vote(self, nearest: list[tuple[int, float]]) -> float:
        """Share of the toxic among the nearest, each weighing its cosine squared over its distance; far ones leave it near 0."""
        total, toxic = NO_VOTE, 0.0
        for row, cosine in nearest:
            w = cosine * cosine / (1.1 - min(cosine, 1.0))
            total += w
            toxic += w * self.model.labels[row]
        return toxic / total

    def votes_of_examples(self, rows: list[int]) -> list[float]:
        """The votes of examples, each left out of its own search."""
        return [self.vote(x) for x in self.index.nearest_of([self.known(i) for i in rows], buts=rows)]

    def score(self, vectors: list[tuple]) -> list[tuple[float, list[tuple[int, float, int]]]]:
        """(score, evidence) of each (terms, counts): evidence holds (example id, cosine, label) of the nearest examples."""
        m = self.model
        if not self.index:
            return [(m.bare, []) for _ in vectors]
        out = []
        for at in range(0, len(vectors), TOGETHER):
            for near in self.index.nearest_of([self.vector(*v) for v in vectors[at : at + TOGETHER]]):
                z = m.slope * self.vote(near) + m.shift
                score = 1 / (1 + math.exp(-max(-50.0, min(50.0, z)))) if near else m.bare
                out.append((score, [(m.ids[r], c, m.labels[r]) for r, c in near]))
        return out


def _sigmoid_fit(raw, labels, counts=None, rounds: int = 60) -> tuple[float, float]:
    """Slope and shift of the sigmoid that fits the votes best, labels drawn in a little as by Platt; the slope is positive.

    A vote may stand for as many examples as ``counts`` says."""
    x, y = np.array(raw, dtype=float), np.array(labels, dtype=float)
    many = np.ones(len(x)) if counts is None else np.array(counts, dtype=float)
    n1, n0 = (many * y).sum(), (many * (1 - y)).sum()
    goal = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a = np.stack([x, np.ones_like(x)], axis=1)
    w = np.array([8.0, -4.0])
    prior = np.diag([1e-2, 1e-2])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -50, 50)))
        h = (a * (many * (p * (1 - p) + 1e-9))[:, None]).T @ a + prior
        step = np.linalg.solve(h, a.T @ (many * (p - goal)) + prior @ (w - np.array([8.0, -4.0])))
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return max(float(w[0]), 0.1), float(w[1])


def choose_terms(terms, leaning, tested: int):
    """Which of ``terms`` (an Arrow array) are the vocabulary: all words, and the beginnings whose lean is beyond chance among so many ``tested`` terms."""
    import pyarrow.compute as pc

    words = ~pc.ends_with(terms, "*").to_numpy(zero_copy_only=False)
    return np.flatnonzero(words | (leaning >= 2 * math.log(max(tested, 2)) + 4))


def _sample(docs: DataFrame, labels: DataFrame, max_examples: int, max_postings: int) -> DataFrame:
    """(doc_id, label, text) of the examples, written; see ``score``."""
    known = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_examples)
    known = materialise(known, "toxicity-examples")
    # At most max_examples rows of two numbers: a proven bound.
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(known), "doc_id")
    # Copies of a text are one example: the smallest id, with the larger label.
    sample = sample.groupBy(F.xxhash64("text").alias("h"), F.length("text").alias("n")).agg(
        F.min("doc_id").alias("doc_id"), F.max("label").alias("label"), F.first("text").alias("text")
    )
    sample = materialise(sample.drop("h", "n"), "toxicity-sample")
    # A text of n characters has at most n / 2 words, and each word as many beginnings as BEGINS; the window is over max_examples rows at most.
    most = F.least(F.length("text") / 2 * (1 + len(BEGINS)), F.lit(max_postings))
    before = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    if (sample.agg(F.sum(most)).first()[0] or 0) <= max_postings:
        return sample
    few = sample.select("doc_id", F.sum(most).over(before).alias("sum")).where(F.col("sum") <= max_postings).select("doc_id")
    return materialise(sample.join(F.broadcast(few), "doc_id"), "toxicity-few")


def _vocabulary(sample: DataFrame) -> tuple[pa.Array, np.ndarray]:
    """The terms, the most frequent first, and their leans; bounded by the sample's words."""

    def count(batches: Iterator) -> Iterator:
        for whole in batches:
            # A part of the batch at a time, as its terms are counted in memory.
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                seen = ({}, {})
                for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist()):
                    side = seen[1 if label else 0]
                    for t in terms_of(text or ""):
                        side[t] = side.get(t, 0) + 1
                rows = [(t, n, 0) for t, n in seen[1].items()] + [(t, 0, n) for t, n in seen[0].items()]
                cols = list(zip(*rows)) or [()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int64(), pa.int64()))], names=["term", "n1", "n0"])

    counts = sample.select("text", "label").mapInArrow(count, "term string, n1 long, n0 long").groupBy("term").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
    # A beginning in fewer texts cannot lean beyond chance; words stay however rare.
    counts = materialise(counts.where("n1 + n0 >= 3 OR NOT endswith(term, '*')"), "toxicity-terms")
    sides = {r["label"]: r["n"] for r in sample.groupBy((F.col("label") > 0).cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n")).collect()}
    all1, all0, tested = sides.get(1, 0), sides.get(0, 0), counts.where("n1 + n0 >= 3").count()
    words = counts.withColumn("n", -F.col("n1") - F.col("n0")).toArrow().sort_by([("n", "ascending"), ("term", "ascending")])
    leaning = leans(words["n1"].to_numpy(), words["n0"].to_numpy(), all1, all0)
    terms = words["term"].combine_chunks()
    chosen = choose_terms(terms, leaning, tested)
    return terms.take(pa.array(chosen)), leaning[chosen]


def _with_vectors(docs: DataFrame, terms: pa.Array, text_col: str, out: str) -> DataFrame:
    """``docs`` with ``out``: the packed numbers and counts of the text's terms."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    @F.arrow_udf("struct<terms:binary,counts:binary>")
    def vectors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # Built by each task and gone with it: a worker that goes on to other stages keeps nothing of it.
        find = Terms({t: i for i, t in enumerate(shared.value.to_pylist())})
        for texts in batches:
            rows = []
            for at in range(0, len(texts), 256):
                rows += [pack_terms(*find(t or "")) for t in texts.slice(at, 256).to_pylist()]
            columns = [pa.array([r[i] for r in rows], pa.binary()) for i in (0, 1)]
            yield pa.StructArray.from_arrays(columns, names=["terms", "counts"])

    return docs.withColumn(out, vectors(F.col(text_col)))


def _document_frequencies(vectors: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """In how many rows of ``vectors`` (terms, counts) each term is, and how many rows there are."""

    def frequency(batches: Iterator) -> Iterator:
        df, n = np.zeros(size, dtype=np.int64), 0
        for batch in batches:
            for terms in batch["terms"].to_pylist():
                df[np.cumsum(_unpack(terms))] += 1
                n += 1
        seen = np.flatnonzero(df)
        cols = (np.append(seen, -1), np.append(df[seen], n))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["term", "n"])

    counted = vectors.select("terms").mapInArrow(frequency, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(size + 1, dtype=np.int64)  # the last one for the number of documents
    df[counted["term"].to_numpy()] = counted["n"].to_numpy()
    return df[:size], int(df[size])


def _calibrate(model: Model, spark) -> None:
    """Fit the model's sigmoid on the votes of its examples, found in tasks; a histogram of them comes to the driver."""
    if not model.ids:
        return
    shared = spark.sparkContext.broadcast(model)

    def votes(batches: Iterator) -> Iterator:
        scorer = Scorer(shared.value)
        for batch in batches:
            rows = batch["id"].to_pylist()
            found = scorer.votes_of_examples(rows)
            step = [round(v * VOTE_STEPS) for v in found]
            yield pa.RecordBatch.from_arrays([pa.array(step, pa.int32()), pa.array([1 if shared.value.labels[i] else 0 for i in rows], pa.int32())], names=["step", "label"])

    rows = spark.range(0, len(model.ids), 1, -(-len(model.ids) // 256)).mapInArrow(votes, "step int, label int")
    table = rows.groupBy("step", "label").agg(F.count(F.lit(1)).alias("n")).orderBy("step", "label").collect()
    model.slope, model.shift = _sigmoid_fit([r["step"] / VOTE_STEPS for r in table], [r["label"] for r in table], [r["n"] for r in table])
    shared.unpersist()


def fit(
    docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text",
    max_examples: int = MAX_EXAMPLES, max_postings: int = MAX_POSTINGS,
) -> tuple[Model, DataFrame]:
    """A calibrated model from ``labels`` (doc_id, label 0 or 1) of texts among ``docs``, and the written ``docs``.

    The examples are the ``max_examples`` labelled ids of smallest hash, as far as they have ``max_postings``
    terms together (all of them, if fewer); ids labelled in two ways take the larger label, and copies of a text
    are one example. The vocabulary are all words of the examples. Document frequencies are those of all ``docs``.

    Each row is written once as (row, v): its columns in ``keep`` (all by default) and the packed terms of its text.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sample = _sample(texts, labels, max_examples, max_postings)
    terms, leaning = _vocabulary(sample)
    # The row travels as one value, so its columns may have any names.
    rows = docs.select(F.struct(*(docs[c] for c in keep or docs.columns)).alias("row"), docs[text_col].alias("text"))
    stage = materialise(_with_vectors(rows, terms, "text", "v").select("row", "v"), "toxicity-vectors")
    df, documents = _document_frequencies(stage.select("v.terms"), len(terms))
    # The root of a log-likelihood ratio is the lean in standard deviations.
    weights = np.log(1 + documents / (1 + df)) * (1 + np.sqrt(leaning))
    # A bounded number of examples and of terms, as numbers.
    known = _with_vectors(sample, terms, "text", "v").select("doc_id", "label", "v.terms", "v.counts").toArrow().sort_by("doc_id")
    labels = [1 if y else 0 for y in known["label"].to_pylist()]
    model = Model(terms, weights, known["doc_id"].to_pylist(), labels, list(zip(known["terms"].to_pylist(), known["counts"].to_pylist())))
    _calibrate(model, docs.sparkSession)
    return model, stage


def _scored(stage: DataFrame, model: Model, threshold: float) -> DataFrame:
    """The columns of ``row`` in ``stage`` (row, v) with score, predicted and evidence; v holds packed terms, or the text itself.

    Texts go through one function, as a second one would have a worker of its own beside each task."""
    shared = stage.sparkSession.sparkContext.broadcast(model)
    texts = not isinstance(stage.schema["v"].dataType, StructType)

    @F.arrow_udf("struct<score:double,evidence:array<struct<example_id:long,cosine:double,label:int>>>")
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(shared.value)
        find = Terms({t: i for i, t in enumerate(shared.value.terms.to_pylist())}) if texts else None
        near = pa.struct([("example_id", pa.int64()), ("cosine", pa.float64()), ("label", pa.int32())])
        for vectors in batches:
            done = []
            # Arrays for a few texts at a time: the evidence of a whole batch as Python objects takes many times their size.
            for at in range(0, max(len(vectors), 1), 4 * TOGETHER):
                part = vectors.slice(at, 4 * TOGETHER).to_pylist()
                found = scorer.score([find(v or "") if texts else unpack_terms(v["terms"], v["counts"]) for v in part])
                evidence = pa.array([[{"example_id": i, "cosine": c, "label": y} for i, c, y in e] for _, e in found], pa.list_(near))
                done.append(pa.StructArray.from_arrays([pa.array([x for x, _ in found], pa.float64()), evidence], names=["score", "evidence"]))
            yield pa.concat_arrays(done)
            del vectors, done, part, found, evidence
        # The worker goes on to other stages; what the arrays took goes back.
        pa.default_memory_pool().release_unused()

    kept = [c for c in stage.schema["row"].dataType.names if c not in ("score", "evidence", "predicted")]
    out = stage.withColumn("v", scores(F.col("v")))
    return out.select(*(F.col("row").getField(c).alias(c) for c in kept), F.col("v.score").alias("score"), (F.col("v.score") >= threshold).cast("int").alias("predicted"), F.col("v.evidence").alias("evidence"))


def score(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, threshold: float = THRESHOLD, **how) -> DataFrame:
    """``docs`` (their columns in ``keep``, all by default) with score, predicted and evidence (example_id, cosine, label of the nearest examples).

    The model is that of ``fit``; ``how`` are its parameters. Null and empty texts have the score of texts without any
    word of the vocabulary. Repeated rows are scored each; rows with null ids too. An empty table gives no rows. All
    kept columns stay, whatever their names; columns named like the three new ones are replaced. Without labels every
    score is that of no evidence.
    """
    model, stage = fit(docs, labels, keep, **how)
    return _scored(stage, model, threshold)


def score_with(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``score`` of other documents with a fitted model; they are not written."""
    return _scored(docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs[text_col].alias("v")), model, threshold)


def held_out(id_col: str = "doc_id"):
    """Rows whose labels are not learnt from: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))
