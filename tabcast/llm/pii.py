"""Personal data by fixed patterns and by bootstrapped contexts, in DataFrame functions only.

Entities that fixed patterns find (emails, IP addresses, cards, phones) are the seeds. The words
before them are lexical patterns; so are those before every other token that looks like an
identifier. Patterns and values form a graph: a pattern's score is the share of its occurrences in
the whole corpus that known or likely entities follow, a value's score grows with the patterns it
follows. After a few rounds of scoring, values after high-confidence patterns are new finds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabcast.llm.common import materialise

# Fixed by the contract: kinds in order, and their patterns. Guards keep a match from being sought inside
# a run that it would have to begin with, and repeats that never need to give back are possessive, so
# very long runs take neither quadratic time nor a deep stack.
_MAIL = "A-Za-z0-9._%+-"
KINDS = {
    "email": rf"(?:\G|(?<![{_MAIL}]))[{_MAIL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Kind of what only its context gives away, and what may be such a value: a token with a digit or an @.
FOUND = "id"
_TOKEN = "A-Za-z0-9._%+@#/:-"
_CANDIDATE = rf"(?<![{_TOKEN}])(?=[A-Za-z._%+#/:-]*[0-9@])[A-Za-z0-9](?:[{_TOKEN}]*[A-Za-z0-9])?"
#: Characters before a value in which its context is sought.
_REACH = 64

#: A pattern needs so many different values after it, and this share of its occurrences.
MIN_VALUES = 5
MIN_CONFIDENCE = 0.5
ROUNDS = 3
#: Patterns up to this many are sent to every task to be counted; more are joined after counting all contexts.
BROADCAST_PATTERNS = 50_000

_SPAN = "array<struct<start:int,end:int,value:string>>"


def _spans(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches with their places in code points, end exclusive."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), hits.alias("hit"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("found"))

    def add(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.length(x["hit"])
        one = F.struct(begin.cast("int").alias("start"), end.cast("int").alias("end"), x["hit"].alias("value"))
        return F.struct(end.cast("int").alias("at"), F.concat(acc["found"], F.array(one)).alias("found"))

    # The piece after the last match has no match beside it.
    whole = F.filter(pairs, lambda x: x["hit"].isNotNull())
    return F.aggregate(whole, start, add, lambda acc: acc["found"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return acc + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.coalesce(F.regexp_replace(p, "^0+(?=.)", "").try_cast("int"), F.lit(256)) <= 255)
    digits = _digits(value)
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    return F.length(digits).between(9, 15) if kind == "phone" else F.lit(True)


def _of_kind(apply, spans: Column, kind: str, f) -> Column:
    """``apply`` (a function over arrays) to ``spans`` with ``f`` of a span and its kind."""
    return apply(spans, lambda x: f(x, kind))


def base_spans(text: Column) -> dict[str, Column]:
    """For each kind the array of (start, end, value) that its pattern finds in ``text`` and its test passes."""
    none = F.array().cast(_SPAN)
    found = {}
    for kind, pattern in KINDS.items():
        may = F.contains(text, F.lit("@")) if kind == "email" else F.contains(text, F.lit("+")) if kind == "phone" else text.rlike("[0-9]")
        spans = _of_kind(F.filter, _spans(text, pattern), kind, lambda x, k: _valid(k, x["value"]))
        found[kind] = F.when(may, spans).otherwise(none)
    return found


def _contexts(text: Column, spans: Column) -> Column:
    """``spans`` with the one and the two words before each, lower-cased, as ``before``."""

    def with_words(x: Column) -> Column:
        reach = F.least(x["start"], F.lit(_REACH))
        left = F.lower(F.substring(text, x["start"] - reach + 1, reach))
        two = F.regexp_extract(left, r"(\S+\s+)?(\S+)\s+$", 0)
        words = F.filter(F.split(two, r"\s+"), lambda w: w != "")
        # A word that may be cut off at the edge of the reach is no context.
        whole = F.when((x["start"] > _REACH) & (F.length(two) >= _REACH), F.array().cast("array<string>")).otherwise(words)
        one = F.slice(whole, -1, 1)
        before = F.when(F.size(whole) == 2, F.concat(one, F.array(F.array_join(whole, " ")))).when(F.size(whole) == 1, one).otherwise(
            F.array().cast("array<string>")
        )
        return F.struct(x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"), before.alias("before"))

    return F.transform(spans, with_words)


def mentions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: row, doc_id, the spans of each kind, and ``candidates``, tokens like identifiers outside of these."""
    t = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    t = t.select("doc_id", "text", *(s.alias(k) for k, s in base_spans(F.col("text")).items()))
    every = F.concat(*(F.col(k) for k in KINDS))
    none = F.array().cast(_SPAN)
    tokens = F.when(F.col("text").rlike("[0-9@]"), _spans(F.col("text"), _CANDIDATE)).otherwise(none)
    t = t.withColumn("tokens", tokens).withColumn("every", every)
    # Words of one digit or so, as in numbered lists, are no identifiers.
    long = lambda x: (F.length(_digits(x["value"])) >= 4) | F.contains(x["value"], F.lit("@"))
    apart = lambda x: ~F.exists("every", lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"]))
    other = F.filter("tokens", lambda x: long(x) & apart(x))
    kinds = [_contexts(F.col("text"), F.col(k)).alias(k) for k in KINDS]
    return t.select(F.monotonically_increasing_id().alias("row"), "doc_id", *kinds, _contexts(F.col("text"), other).alias("candidates"))


def _pattern_counts(docs: DataFrame, patterns: DataFrame, text_col: str) -> DataFrame:
    """(pattern, total): how often each of ``patterns`` (one or two words) occurs in all texts."""
    words = F.filter(F.split(F.lower(F.col(text_col)), r"\s+"), lambda w: w != "")
    w = docs.select(words.alias("w")).where(F.size("w") > 0)
    pairs = F.arrays_zip(F.concat(F.array(F.lit("")), F.slice("w", F.lit(1), F.size("w") - 1)).alias("a"), F.col("w").alias("b"))
    w = w.select(F.inline(pairs)).select(F.explode(F.array(F.col("b"), F.concat_ws(" ", "a", "b"))).alias("pattern"))
    if patterns.count() <= BROADCAST_PATTERNS:
        w = w.join(F.broadcast(patterns.select("pattern")), "pattern", "left_semi")
        return w.groupBy("pattern").agg(F.count(F.lit(1)).alias("total"))
    return w.groupBy("pattern").agg(F.count(F.lit(1)).alias("total")).join(patterns.select("pattern"), "pattern", "left_semi")


def trusted_patterns(
    found: DataFrame, docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS, min_values: int = MIN_VALUES, min_confidence: float = MIN_CONFIDENCE
) -> DataFrame:
    """(pattern, confidence) of the contexts to trust, by ``rounds`` rounds over the graph of patterns and values.

    A pattern's confidence is the sum of the scores of the values seen after it over its total
    occurrences in the corpus; it counts from ``min_values`` different values of score 0.5 or more
    on, as a few seeds after a rare word prove nothing. A seed's score is 1; any other value's is
    one less the chance that all its trusted patterns err.
    """
    known = found.select(F.explode(F.concat(*(F.col(k) for k in KINDS))).alias("x")).select("x.value", F.explode("x.before").alias("pattern"), F.lit(True).alias("seed"))
    maybe = found.select(F.explode("candidates").alias("x")).select("x.value", F.explode("x.before").alias("pattern"), F.lit(False).alias("seed"))
    # A row per value and pattern, whatever the number of copies of a text.
    graph = known.unionByName(maybe).groupBy("pattern", "value").agg(F.max("seed").alias("seed"), F.count(F.lit(1)).alias("n"))
    wide = graph.groupBy("pattern").agg(F.count(F.lit(1)).alias("values")).where(F.col("values") >= min_values)
    graph = materialise(graph.join(wide.select("pattern"), "pattern"), "pii-graph")
    totals = materialise(_pattern_counts(docs, graph.select("pattern").distinct(), text_col), "pii-totals")
    graph = materialise(graph.join(totals, "pattern"), "pii-edges")
    scores = graph.groupBy("value").agg(F.max(F.col("seed").cast("double")).alias("score"))
    trusted = None
    for _ in range(rounds):
        p = graph.join(scores, "value").groupBy("pattern").agg(
            (F.sum(F.col("n") * F.col("score")) / F.max("total")).alias("confidence"), F.count(F.when(F.col("score") >= 0.5, 1)).alias("values")
        )
        p = p.where((F.col("values") >= min_values) & (F.col("confidence") >= min_confidence))
        trusted = materialise(p.select("pattern", F.least("confidence", F.lit(1.0)).alias("confidence")), "pii-patterns")
        err = F.log(F.greatest(1 - F.coalesce("confidence", F.lit(0.0)), F.lit(1e-6)))
        scores = materialise(
            graph.join(trusted, "pattern", "left").groupBy("value").agg(
                F.when(F.max("seed"), F.lit(1.0)).otherwise(1 - F.exp(F.sum(err))).alias("score")
            ),
            "pii-scores",
        )
    return trusted


def find_entities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """Per row: doc_id and the arrays of (start, end, value, before) of email, ip, card, phone and id.

    Places are code points, end exclusive. ``id`` holds what follows a trusted pattern. Null text is
    empty and has no spans; rows that repeat are searched each; null ids stay. An empty table gives
    no rows. Extra columns are ignored.
    """
    found = materialise(mentions(docs, id_col, text_col), "pii-mentions")
    trusted = trusted_patterns(found, docs.select(F.coalesce(F.col(text_col), F.lit("")).alias(text_col)), text_col, **kw)
    new = found.select("row", F.explode("candidates").alias("x")).select("row", "x", F.explode("x.before").alias("pattern"))
    new = new.join(trusted, "pattern").groupBy("row").agg(F.sort_array(F.collect_set("x")).alias(FOUND))
    out = found.join(new, "row", "left")
    none = F.array().cast("array<struct<start:int,end:int,value:string,before:array<string>>>")
    return out.select("doc_id", *KINDS, F.coalesce(FOUND, none).alias(FOUND))


def span_list(kinds: list[str]) -> Column:
    """``kind:start:end`` of the spans of ``kinds``, by kind as listed, then start, joined by commas."""
    parts = [_of_kind(F.transform, F.col(k), k, lambda x, k: F.concat_ws(":", F.lit(k), x["start"], x["end"])) for k in kinds]
    return F.array_join(F.concat(*parts), ",")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...) with every entity replaced by its kind in brackets; the columns stay.

    Overlapping entities are replaced together, by the kind of the first. Every row is cut at its own
    spans: null ids stay, rows that repeat an id or a text are redacted each. ``n_chars``, where there
    is one, follows the text.
    """
    # The row travels as one value, so its columns may have any names; its key is written with it.
    d = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), F.monotonically_increasing_id().alias("nth"))
    d = materialise(d, "pii-rows")
    e = find_entities(d.select("nth", F.col("row")["text"].alias("text")), id_col="nth")
    kinds = [*KINDS, FOUND]
    tag = lambda x, k: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(k).alias("kind"))
    tagged = F.concat(*(_of_kind(F.transform, F.col(k), k, tag) for k in kinds))
    e = e.select(F.col("doc_id").alias("nth"), F.sort_array(tagged).alias("spans")).where(F.size("spans") > 0)
    out = d.join(e, "nth", "left")
    whole, clean = F.col("row")["text"], F.col("spans").isNull()
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))

    def add(acc: Column, x: Column) -> Column:
        gap = F.substring(whole, acc["at"] + 1, F.greatest(x["start"] - acc["at"], F.lit(0)))
        more = F.when(x["start"] >= acc["at"], F.concat(acc["text"], gap, F.lit("["), F.upper(x["kind"]), F.lit("]"))).otherwise(acc["text"])
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), more.alias("text"))

    cut = F.aggregate("spans", start, add, lambda acc: F.concat(acc["text"], F.substring(whole, acc["at"] + 1, F.length(whole))))
    text = F.when(clean, whole).otherwise(cut)
    cols = []
    for c in docs.columns:
        if c == "n_chars":
            cols.append(F.when(clean, F.col("row")[c]).otherwise(F.length(text)).cast(docs.schema[c].dataType).alias(c))
        else:
            cols.append((text if c == "text" else F.col("row")[c]).alias(c))
    return out.select(*cols)
