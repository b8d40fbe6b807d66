"""Mixing sources to target weights, in DataFrame functions only.

Every document gets a hash-random key. Within a source, documents are dealt to key ranges (the
leading hex digits of the key), sorted inside each range, and a two-level prefix sum of their
sizes gives each document's place in its source's shuffled order. The order is cut at the
source's exact budget; a budget above the source's size repeats the order for whole epochs first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabcast.llm.common import WORD, materialise


def word_count(text: Column) -> Column:
    """Number of words of ``text``; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), limit: int = 3) -> DataFrame:
    """``sizes`` (source, source_size) with weight and target.

    Sources by code point, null last, take ``weights`` in turn and share the sum of all sizes by
    weight; a target stops at ``limit`` times its source's size and the excess is shared again.
    That is the level ``x`` at which sum(min(limit * size, x * weight)) is the sum of all sizes.
    One row per source: the prefix sums over them order sources by the level at which each stops.
    The order of sources is numbered in one window, as its rows are the sources, not the documents.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source")))
    w = F.element_at(F.array(*(F.lit(x) for x in weights)), F.pmod(rank - 1, F.lit(len(weights))) + 1)
    s = sizes.withColumn("weight", w.cast("double")).withColumn("stop", F.col("source_size") * limit / F.col("weight"))
    upto = Window.orderBy("stop", F.col("source").isNull(), "source")
    all_rows = Window.partitionBy()
    before = upto.rowsBetween(Window.unboundedPreceding, -1)
    s = s.select(
        "*",
        F.row_number().over(upto).alias("nth"),
        F.coalesce(F.sum(F.col("source_size") * limit).over(before), F.lit(0)).alias("stopped"),
        F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("stopped_weight"),
        F.sum("source_size").over(all_rows).alias("total"),
        F.sum("weight").over(all_rows).alias("weights"),
    )
    # With the earlier sources stopped, the level of the rest; the first source not above its stop fixes it.
    level = (F.col("total") - F.col("stopped")) / (F.col("weights") - F.col("stopped_weight"))
    s = s.withColumn("level", level)
    found = F.when(F.col("level") <= F.col("stop"), F.struct("nth", "level"))
    s = s.withColumn("x", F.min(found).over(all_rows)["level"])
    target = F.when(F.col("x").isNull() | (F.col("stop") < F.col("x")), (F.col("source_size") * limit).cast("double")).otherwise(
        F.col("x") * F.col("weight")
    )
    return s.select("source", "source_size", F.col("weight").cast("int").alias("weight"), target.alias("target"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    limit: int = 3,
    seed: int = 17,
    range_digits: int = 2,
    row_col: str | None = None,
) -> DataFrame:
    """Per document: doc_id, source, size, weight, source_size, target, first_word, taken, epochs, part.

    ``taken`` counts the words the mix takes of the document, repeats counted: ``epochs`` whole
    copies and ``part`` leading words of one more. The words taken of a source sum to its target,
    rounded to a whole word. ``16 ** range_digits`` key ranges split each source (a parameter:
    choose it so that the largest source's documents over that number fit a sort).

    Null text has size 0 and takes 0; a null source is a source of its own, the last one; null ids
    are keyed as the empty string. Rows that repeat an id and size are interchangeable, unless
    ``row_col`` names a key of the rows: it then decides between them and is a first column of the
    result. An empty table gives no rows. Extra columns are ignored.
    """
    key = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(f":{seed}")))
    nth = [F.col(row_col).alias("nth")] if row_col else []
    slim = docs.select(
        *nth, F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), key.alias("key")
    ).withColumn("range", F.substring("key", 1, range_digits))
    slim = materialise(slim, "mix-sizes")
    # The documents of a range count first, so that no more than a row per source and range moves.
    ranges = slim.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    targets = source_targets(ranges.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, limit)
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("source", "range", F.coalesce(F.sum("range_size").over(before), F.lit(0)).alias("start"))
    plan = starts.alias("r").join(targets.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source")))
    plan = materialise(plan.select("r.source", "r.range", "r.start", "t.source_size", "t.weight", "t.target"), "mix-plan")
    inside = Window.partitionBy("source", "range").orderBy("key", "size", *(["nth"] if row_col else [])).rowsBetween(Window.unboundedPreceding, -1)
    placed = slim.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    budget = F.round("target").cast("long")
    per = F.greatest(F.col("source_size"), F.lit(1))
    whole = F.floor(budget / per).cast("long")
    on = F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("d.range") == F.col("p.range"))
    out = placed.alias("d").join(plan.alias("p"), on)
    out = out.withColumn("first_word", F.col("p.start") + F.col("d.inside"))
    part = F.greatest(F.lit(0), F.least(F.col("size"), budget - whole * F.col("source_size") - F.col("first_word")))
    return out.select(
        *([F.col("nth").alias(row_col)] if row_col else []),
        "doc_id",
        F.col("d.source").alias("source"),
        "size",
        "weight",
        "source_size",
        "target",
        "first_word",
        (whole * F.col("size") + part).cast("long").alias("taken"),
        whole.alias("epochs"),
        part.cast("long").alias("part"),
    )


def mixed_documents(docs: DataFrame, seed: int = 17, **kw) -> DataFrame:
    """``docs`` as the mix takes them: each row once per whole epoch, then its leading ``part`` words.

    Rows that the mix does not take go; the columns stay. ``n_chars``, where there is one, follows
    the text of a cut document. Every row is taken by its own share: null ids stay, and rows that
    repeat an id are documents each.
    """
    # The row travels as one value, so its columns may have any names; its key is written with it.
    d = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), F.monotonically_increasing_id().alias("nth"))
    d = materialise(d, "mix-rows")
    keyed = d.select("nth", *(F.col("row")[c].alias(c) for c in ("doc_id", "text", "source")))
    m = mix(keyed, seed=seed, row_col="nth", **kw).where("taken > 0").select("nth", "size", "epochs", "part")
    out = d.join(m, "nth")
    # An entry is the number of words of that copy: the size for whole epochs, the part for the last one.
    copies = F.concat(
        F.array_repeat(F.col("size"), F.col("epochs").cast("int")),
        F.when(F.col("part") > 0, F.array(F.col("part"))).otherwise(F.array().cast("array<bigint>")),
    )
    out = out.select("row", "size", F.explode(copies).alias("words"))
    whole, cut = F.col("row")["text"], F.col("words") < F.col("size")
    head = F.array_join(F.slice(F.regexp_extract_all(whole, F.lit(f"({WORD})"), F.lit(1)), F.lit(1), F.col("words").cast("int")), " ")
    text = F.when(cut, head).otherwise(whole)
    cols = []
    for c in docs.columns:
        if c == "n_chars":
            cols.append(F.when(cut, F.length(text)).otherwise(F.col("row")[c]).cast(docs.schema[c].dataType).alias(c))
        else:
            cols.append((text if c == "text" else F.col("row")[c]).alias(c))
    return out.select(*cols)
