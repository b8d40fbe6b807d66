"""Language identification by a linear-chain conditional random field over words.

A word's features are its beginnings and ends, its inner letter n-grams and the languages whose
lexicon of common words has it; transitions between the languages of neighbouring words are
learnt too, from sequences that switch between texts of different languages. Forward and backward
sums give each word's chances over the languages, which label code-switched texts word by word; a
document's language is the one of most words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabcast.llm.common import materialise

#: Training rows per language, at most about, and runs of words taken from all over each of them.
ROWS_PER_LANGUAGE = 400
RUNS_PER_ROW = 12
RUN_WORDS = 24
FEATURE_BITS = 17
LEXICON = 300
#: Words whose scores a task keeps at hand.
WORDS_KEPT = 200_000
UNKNOWN = "und"
_words = re.compile(r"[^\W\d_]+").findall


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased."""
    return _words(text.lower())


def features(word: str, lexicons: list[frozenset]) -> list[int]:
    """Feature numbers of a word: affixes up to 4 letters, n-grams of 3, lexicons, and one for every word."""
    w = word if len(word) <= 40 else word[:20] + word[-20:]
    marked = f"<{w}>"
    names = {marked[:k] for k in (2, 3, 4, 5)} | {marked[-k:] for k in (2, 3, 4, 5)} | {marked}
    names.update([w[i : i + 3] for i in range(len(w) - 2)])
    mask, first = (1 << FEATURE_BITS) - 1, len(lexicons) + 1
    return [0, *(1 + i for i, lex in enumerate(lexicons) if word in lex), *(first + (zlib.crc32(n.encode()) & mask) for n in names)]


def forward_backward(emit, lengths, move, begin):
    """Posterior chances of labels, and expected transitions.

    ``emit`` (steps, sequences, labels) holds scores, padded after each sequence's length; ``move``
    and ``begin`` are scores of transitions and of first labels. Returns the posteriors (same shape)
    and the sum over sequences and steps of the chances of each transition.
    """
    import numpy as np

    steps, count, labels = emit.shape
    top = emit.max(axis=2, keepdims=True)
    e, a = np.exp(emit - top), np.exp(move - move.max())
    alpha, beta = np.empty_like(e), np.ones_like(e)
    alpha[0] = np.exp(begin - begin.max()) * e[0]
    alpha[0] /= alpha[0].sum(1, keepdims=True)
    for t in range(1, steps):
        x = (alpha[t - 1] @ a) * e[t]
        alpha[t] = x / x.sum(1, keepdims=True)
    for t in range(steps - 2, -1, -1):
        x = (beta[t + 1] * e[t + 1]) @ a.T
        x /= x.sum(1, keepdims=True)
        inside = (lengths > t + 1)[:, None]
        beta[t] = np.where(inside, x, 1.0)
    post = alpha * beta
    post /= post.sum(2, keepdims=True)
    moved = np.zeros((labels, labels))
    for t in range(1, steps):
        live = lengths > t
        pair = alpha[t - 1][live][:, :, None] * a[None] * (beta[t] * e[t])[live][:, None, :]
        moved += (pair / pair.sum((1, 2), keepdims=True)).sum(0)
    return post, moved


class Tagger:
    """A fitted field: languages, lexicons, feature weights and transitions."""

    def __init__(self, languages: list[str], lexicons: list[frozenset], weights, move, begin):
        self.languages, self.lexicons, self.weights, self.move, self.begin = languages, lexicons, weights, move, begin

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("index", "table")}

    def _score_rows(self, texts: list[list[str]]):
        """Rows of the table of word scores, for all words of all texts in order; words not at hand are scored first."""
        import numpy as np

        if "index" not in self.__dict__ or len(self.index) > WORDS_KEPT:
            self.index, self.table = {}, np.zeros((0, len(self.languages)))
        index = self.index
        new = list({w for t in texts for w in t if w not in index})
        if new:
            feats = [features(w, self.lexicons) for w in new]
            sizes = np.array([len(f) for f in feats])
            starts = np.cumsum(sizes) - sizes
            scores = np.add.reduceat(self.weights[np.fromiter((x for f in feats for x in f), np.int64, int(sizes.sum()))], starts, axis=0)
            index.update(zip(new, range(len(index), len(index) + len(new))))
            self.table = np.concatenate([self.table, scores])
        return np.fromiter((index[w] for t in texts for w in t), np.int64, sum(map(len, texts)))

    def _groups(self, texts: list[list[str]]) -> Iterator:
        """(places of the texts, lengths, mask, posteriors by step and text) for groups of texts of like length."""
        import numpy as np

        order = sorted((i for i, t in enumerate(texts) if t), key=lambda i: len(texts[i]))
        at = 0
        while at < len(order):
            size = 512
            while size > 1 and size * len(texts[order[min(at + size, len(order)) - 1]]) > 400_000:
                size //= 2
            part = order[at : at + size]
            at += size
            lengths = np.array([len(texts[i]) for i in part])
            mask = np.arange(lengths.max()) < lengths[:, None]
            emit = np.zeros((*mask.shape, len(self.languages)))
            rows = self._score_rows([texts[i] for i in part])
            emit[mask] = self.table[rows]
            yield part, lengths, mask.T, _smooth(np.ascontiguousarray(emit.swapaxes(0, 1)), lengths, self.move, self.begin)

    def label_words(self, text: str) -> list[tuple[str, str, float]]:
        """(word, language, chance) of every word of a text."""
        words = words_of(text)
        for _, _, _, post in self._groups([words]):
            return [(w, self.languages[int(p.argmax())], float(p.max())) for w, p in zip(words, post[:, 0])]
        return []

    def languages_of(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, mean chance of its words) of every text; no letters, or nothing learnt: unknown, 0."""
        found = [(UNKNOWN, 0.0)] * len(texts)
        if not self.languages:
            return found
        for part, lengths, mask, post in self._groups([words_of(t or "") for t in texts]):
            mean = (post * mask[:, :, None]).sum(0) / lengths[:, None]
            best = mean.argmax(1)
            for i, k, m in zip(part, best.tolist(), mean.max(1).tolist()):
                found[i] = (self.languages[k], min(m, 1.0))
        return found


def _smooth(emit, lengths, move, begin):
    """The posteriors of :func:`forward_backward` alone."""
    import numpy as np

    steps = len(emit)
    e = np.exp(emit - emit.max(axis=2, keepdims=True))
    a = np.exp(move - move.max())
    back = np.ascontiguousarray(a.T)
    beta = np.ones_like(e)
    shortest = int(lengths.min())
    for t in range(steps - 1, 0, -1):
        later = (beta[t] * e[t]) @ back
        later /= later.sum(1, keepdims=True)
        # Steps beyond a text's end say nothing about the words before.
        beta[t - 1] = later if t < shortest else np.where((lengths > t)[:, None], later, 1.0)
    x = np.exp(begin - begin.max()) * e[0]
    for t in range(steps):
        if t:
            x = (x @ a) * e[t]
        x = x / x.sum(1, keepdims=True)
        beta[t] *= x
    return beta / beta.sum(2, keepdims=True)


def train(runs: list[tuple[str, list[str]]], epochs: int = 4, rate: float = 0.25, pieces: int = 3, batch: int = 64, seed: int = 5) -> Tagger:
    """A tagger from (language, words) runs, joined to sequences of ``pieces`` runs that switch languages.

    Languages take turns evenly, so a rare one is learnt as well as a common one. Adaptive gradient
    steps on the log-likelihood of the whole sequences, with a small pull of the weights to 0.
    """
    import numpy as np

    languages = sorted({lang for lang, _ in runs})
    if not languages:
        return Tagger([], [], np.zeros((1, 0)), np.zeros((0, 0)), np.zeros(0))
    counts = {lang: Counter() for lang in languages}
    by_language: dict[str, list[list[str]]] = {lang: [] for lang in languages}
    for lang, words in runs:
        counts[lang].update(words)
        by_language[lang].append(words)
    lexicons = [frozenset(w for w, _ in sorted(counts[lang].items(), key=lambda x: (-x[1], x[0]))[:LEXICON]) for lang in languages]
    size, n = (1 << FEATURE_BITS) + len(lexicons) + 1, len(languages)
    types = {w: i for i, w in enumerate(sorted({w for _, ws in runs for w in ws}))}
    feats = [np.array(features(w, lexicons)) for w in types]
    weights, move, begin = np.zeros((size, n)), np.zeros((n, n)), np.zeros(n)
    seen = [np.full(x.shape, 1e-3) for x in (weights, move, begin)]
    rng = np.random.Generator(np.random.PCG64(seed))
    most = max(len(x) for x in by_language.values())
    for _ in range(epochs):
        drawn = []
        for label, lang in enumerate(languages):
            own = by_language[lang]
            turns = [own[i] for i in rng.permutation(len(own))]
            drawn += [(label, turns[i % len(turns)]) for i in range(most)]
        drawn = [drawn[i] for i in rng.permutation(len(drawn))]
        sequences = [drawn[i : i + pieces] for i in range(0, len(drawn), pieces)]
        for at in range(0, len(sequences), batch):
            part = sequences[at : at + batch]
            ids = [[types[w] for _, ws in s for w in ws] for s in part]
            gold = [[label for label, ws in s for _ in ws] for s in part]
            lengths = np.array([len(x) for x in ids])
            flat = np.array([i for x in ids for i in x])
            used, where = np.unique(flat, return_inverse=True)
            sizes = [len(feats[i]) for i in used]
            rows = np.concatenate([feats[i] for i in used])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            scores = np.add.reduceat(weights[rows], starts, axis=0)
            emit = np.zeros((lengths.max(), len(part), n))
            place = [(t, b) for b, x in enumerate(ids) for t in range(len(x))]
            ts, bs = np.array(place).T
            emit[ts, bs] = scores[where]
            post, moved = forward_backward(emit, lengths, move, begin)
            labels = np.array([y for x in gold for y in x])
            error = post[ts, bs]
            error[np.arange(len(labels)), labels] -= 1
            by_type = np.zeros((len(used), n))
            np.add.at(by_type, where, error)
            grad = np.zeros((size, n))
            np.add.at(grad, rows, np.repeat(by_type, sizes, axis=0))
            touched = np.unique(rows)
            real = np.zeros((n, n))
            for x in gold:
                np.add.at(real, (x[:-1], x[1:]), 1)
            first = post[0].sum(0) - np.bincount([x[0] for x in gold], minlength=n)
            for param, g, acc, rows_ in ((weights, grad, seen[0], touched), (move, moved - real, seen[1], slice(None)), (begin, first, seen[2], slice(None))):
                step = g[rows_] / len(part) + 1e-5 * param[rows_]
                acc[rows_] += step * step
                param[rows_] -= rate * step / np.sqrt(acc[rows_])
    return Tagger(languages, lexicons, weights, move, begin)


def training_runs(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> list[tuple[str, list[str]]]:
    """(language, words) runs of a bounded sample of ``docs`` (doc_id, text, lang), spread over the whole of each text."""
    known = docs.where("lang IS NOT NULL AND doc_id IS NOT NULL AND text IS NOT NULL")
    slim = known.select("doc_id", "lang")
    sizes = slim.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    # A hash between 0 and 1 keeps somewhat more than the rows wanted; a window over these few takes the exact number.
    draw = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30)) / F.lit(1 << 30)
    # One row per language, and the tagger holds them all anyway.
    few = slim.join(F.broadcast(sizes), "lang").withColumn("draw", draw).where(F.col("draw") * F.col("rows") <= 2 * rows_per_language)
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id"))
    few = materialise(few.withColumn("turn", turn).where(F.col("turn") <= rows_per_language).select("doc_id").distinct(), "language-sample")
    # As many rows as languages times rows_per_language, at most.
    sample = known.join(F.broadcast(few), "doc_id").select("doc_id", "lang", "text")

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out = []
            for i, lang, text in zip(batch["doc_id"].to_pylist(), batch["lang"].to_pylist(), batch["text"].to_pylist()):
                words = words_of(text)
                starts = range(0, len(words), RUN_WORDS)
                step = max(1, len(starts) // RUNS_PER_ROW)
                out += [(i, lang, words[s : s + RUN_WORDS]) for s in starts[::step][:RUNS_PER_ROW]]
            cols = list(zip(*out)) or [()] * 3
            kinds = (pa.int64(), pa.string(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["doc_id", "lang", "words"])

    rows = sample.mapInArrow(cut, "doc_id long, lang string, words array<string>").orderBy("doc_id", "words").collect()
    return [(r["lang"], r["words"]) for r in rows]


def fit(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> Tagger:
    """A tagger from the rows of ``docs`` (doc_id, text, lang) that have a language; a word's language is its row's.

    Without such rows it knows no language and every text is unknown.
    """
    return train(training_runs(docs, rows_per_language))


def identify(docs: DataFrame, tagger: Tagger, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score, the mean chance of the predicted language over the words.

    Null texts and texts without a letter are ``und`` with score 0. Repeated rows are judged each.
    An empty table gives no rows. All other columns stay; columns of these two names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def judge(texts):
        import pandas as pd

        own, found = shared.value, []
        rows = list(texts)
        for at in range(0, len(rows), 2000):
            found += own.languages_of(rows[at : at + 2000])
        return pd.DataFrame(found, columns=["lang_pred", "score"])

    out = docs.withColumn("_language", judge(F.col(text_col)))
    return out.withColumns({"lang_pred": F.col("_language.lang_pred"), "score": F.col("_language.score")}).drop("_language")
