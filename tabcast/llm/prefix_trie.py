"""A prefix trie of conversations, built as a z-fast trie by batches of joins.

A conversation is a sequence of turns; every prefix of it has a digest, so prefixes are compared
and looked up by (depth, digest). The trie is kept compacted: a node is where conversations branch or
end, and stands for the edge (parent's depth, own depth] above it. Each node is stored under one
handle, its prefix at the two-fattest depth of its edge: the depth that the most powers of two divide.
The node below which a conversation leaves the trie is then found by fat binary search, in as many
lookups as the length of a conversation has binary digits.

Conversations come in batches that grow geometrically. A batch is located in the trie of the earlier
ones by such lookups, each a join for the whole batch. Those that leave it at the same place with
the same next turn are a group: one drawn at random is inserted as a new path, the others are compared
with it and go on as smaller groups, so the rounds are a logarithm of the group's size. At the end
edges are expanded to one node per depth, and sums go from the last paths up to the root.

Hot prefixes, of which a sample names a bounded number, are dealt over many tasks in every lookup.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabcast.llm.common import materialise, shares as _shares, spread_join

#: Conversations of the first batch, and how much larger each later one is.
FIRST_BATCH = 4096
GROWTH = 16
#: A prefix is hot if it has this share of the prefixes of a sample of so many conversations.
HOT_SHARE = 1 / 4096
HOT_SAMPLE = 65_536
#: Lookups of the search that one plan holds; the driver's memory grows with a plan.
ROUNDS_A_PLAN = 3
#: Ids that are joined to one text before they are hashed.
IDS_A_CHUNK = 4096
ROOT = -1

def sequences(rows: DataFrame) -> DataFrame:
    """Conversations as (conv_id, turns): digest and number of code points of each turn, in order.

    ``rows``: conv_id, turn, role, text. Turns are ordered by turn, null first, equal ones by the
    MD5 of role and text; a null role or text is empty. Rows with a null conv_id belong to no conversation and are left out.
    The texts stay where they are read: 16 bytes and a number of each turn meet in one row.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    order = F.struct(F.col("turn"), F.md5(role).alias("r"), F.md5(text).alias("t"))
    one = F.struct(order.alias("at"), digest.alias("digest"), F.length(text).alias("chars"))
    slim = rows.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), one.alias("one"))
    turns = F.transform(F.array_sort(F.collect_list("one")), lambda x: F.struct(x["digest"].alias("digest"), x["chars"].alias("chars")))
    return slim.groupBy("conv_id").agg(turns.alias("turns"))


def _prefixes(batches: Iterator) -> Iterator:
    """Digests of all prefixes of each conversation, the whole one last."""
    import pyarrow as pa

    empty = hashlib.md5(b"", usedforsecurity=False).digest()
    for batch in batches:
        out = []
        for conv, turns in zip(batch["conv_id"].to_pylist(), batch["turns"].to_pylist()):
            at, hs, chars = empty, [], []
            for t in turns or []:
                at = hashlib.md5(at + t["digest"], usedforsecurity=False).digest()
                hs.append(at)
                chars.append(t["chars"])
            out.append((conv, at, hs, chars))
        cols = list(zip(*out)) or [()] * 4
        kinds = (pa.int64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["conv_id", "whole", "hs", "chars"])


def two_fattest(low: str, high: str) -> Column:
    """The number in (low, high] that the highest power of two divides; ``low`` < ``high`` are SQL expressions."""
    bits = f"(length(bin(({low}) ^ ({high}))) - 1)"
    return F.expr(f"shiftleft(shiftright({high}, {bits}), {bits})")


def _hot_prefixes(batch: DataFrame, rows: int) -> DataFrame:
    """(depth, hash) of the prefixes with more than HOT_SHARE of a sample's prefixes: 1 / HOT_SHARE rows at most."""
    drawn = batch if rows <= HOT_SAMPLE else batch.where(F.col("u") % F.lit(rows // HOT_SAMPLE) == 0)
    counts = drawn.select(F.posexplode("hs").alias("i", "hash")).groupBy((F.col("i") + 1).alias("depth"), "hash").agg(F.count(F.lit(1)).alias("n"))
    counts = materialise(counts.where("n > 1"), "trie-prefix-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.where(F.col("n") >= max(2, int(total * HOT_SHARE))).select("depth", "hash")


def locate(batch: DataFrame, nodes: DataFrame, longest: int, hot: DataFrame, shares: int) -> DataFrame:
    """Where each conversation of ``batch`` leaves the trie: columns path, level and depth of the place, added to its own.

    Fat binary search over the handles finds the deepest node whose whole prefix the conversation
    has; one more lookup finds the edge below that begins with its next turn, if any, and how far it
    follows that edge.
    """
    handles = nodes.select(F.col("f").alias("depth"), F.col("fh").alias("hash"), F.struct("path", "level", "low", F.col("depth").alias("d"), "eh").alias("node"))
    q = batch.withColumns({"l": F.lit(0), "r": F.col("len"), "path": F.lit(ROOT).cast("long"), "level": F.lit(0)})
    for step_ in range(longest.bit_length()):
        if step_ and step_ % ROUNDS_A_PLAN == 0:
            q = materialise(q, "trie-search")
        open_ = F.col("l") < F.col("r")
        f = F.when(open_, two_fattest("l", "r")).otherwise(-1 - F.col("len"))
        q = q.withColumn("depth", f).withColumn("hash", F.when(open_, F.element_at("hs", F.greatest("depth", F.lit(1)))).otherwise(F.col("whole")))
        q = spread_join(q, handles, ["depth", "hash"], hot, "cid", shares)
        inside = F.col("node.d") <= F.col("len")
        whole = inside & (F.element_at("hs", F.when(inside, F.col("node.d")).otherwise(F.lit(1))) == F.col("node.eh"))
        step = F.when(~open_, F.struct("l", "r", "path", "level"))
        step = step.when(F.col("node").isNull(), F.struct("l", (F.col("depth") - 1).alias("r"), "path", "level"))
        step = step.when(whole, F.struct(F.col("node.d").alias("l"), "r", F.col("node.path").alias("path"), F.col("node.level").alias("level")))
        # It has the handle, not the whole edge: it leaves the trie on this edge.
        step = step.otherwise(F.struct(F.col("node.low").alias("l"), F.col("node.low").alias("r"), "path", "level"))
        q = q.withColumn("step", step).drop("l", "r", "path", "level", "node", "depth", "hash").select("*", "step.*").drop("step")
    edges = nodes.select((F.col("low") + 1).alias("depth"), F.col("bh").alias("hash"), F.struct("path", "level", "edge").alias("node"))
    more = F.col("len") > F.col("l")
    q = q.withColumn("depth", F.when(more, F.col("l") + 1).otherwise(-1 - F.col("len")))
    q = q.withColumn("hash", F.when(more, F.element_at("hs", F.greatest("depth", F.lit(1)))).otherwise(F.col("whole")))
    q = spread_join(q, edges, ["depth", "hash"], hot, "cid", shares)
    on_edge = F.col("node").isNotNull()
    steps = F.least(F.size("node.edge"), F.col("len") - F.col("l"))
    follows = F.size(F.filter(F.sequence(F.lit(1), F.greatest(steps, F.lit(1))), lambda i: F.element_at("node.edge", i) == F.element_at("hs", F.col("l") + i)))
    return q.select(
        *batch.columns,
        F.when(on_edge, F.col("node.path")).otherwise(F.col("path")).alias("path"),
        F.when(on_edge, F.col("node.level")).otherwise(F.col("level")).alias("level"),
        F.when(on_edge, F.col("l") + follows).otherwise(F.col("l")).cast("int").alias("depth"),
    )


_OWN = ["cid", "u", "whole", "len", "hs", "chars"]


def _insert(located: DataFrame, hot: DataFrame, shares: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """New paths (path, parent, level, low, len, hs, chars) and ends (cid, path, level, depth) of located conversations."""
    paths, ends = [], []
    at = materialise(located, "trie-located")
    while True:
        ends.append(at.where("depth = len").select("cid", "path", "level", "depth"))
        on = at.where("depth < len").withColumnsRenamed({"path": "parent", "depth": "low"})
        on = on.withColumns({"depth": F.col("low") + 1, "hash": F.element_at("hs", F.col("low") + 1)})
        picked = F.struct(F.col("cid").alias("path"), F.col("len").alias("plen"), F.slice("hs", F.col("low") + 1, F.greatest(F.col("len") - F.col("low"), F.lit(0))).alias("edge"))
        first = on.groupBy("depth", "hash").agg(F.min_by(picked, F.struct("u", "cid")).alias("new"))
        m = spread_join(on, first, ["depth", "hash"], hot, "cid", shares)
        steps = F.least(F.col("new.plen"), F.col("len")) - F.col("low")
        follows = F.size(F.filter(F.sequence(F.lit(1), steps), lambda i: F.element_at("new.edge", i) == F.element_at("hs", F.col("low") + i)))
        m = m.select(*_OWN, F.col("new.path").alias("path"), (F.col("level") + 1).alias("level"), "parent", "low", (F.col("low") + follows).cast("int").alias("depth"))
        at = materialise(m, "trie-round")
        if at.isEmpty():
            return paths, ends
        paths.append(at.where("cid = path").select("path", "parent", "level", "low", "len", "hs", "chars"))
        at = at.drop("parent", "low")


def _nodes(paths: DataFrame, ends: DataFrame) -> DataFrame:
    """The compacted nodes with their handles: a path is cut where other paths leave it and conversations end."""
    cuts = paths.select(F.col("parent").alias("path"), F.col("low").alias("depth")).unionByName(ends.select("path", "depth")).where(F.col("path") != ROOT)
    # A path has no more cuts than turns.
    cuts = cuts.distinct().groupBy("path").agg(F.array_sort(F.collect_list("depth")).alias("cuts"))
    parts = paths.join(cuts, "path").select("path", "level", "hs", "low", "cuts", F.posexplode("cuts").alias("i", "depth"))
    parts = parts.withColumn("low", F.when(F.col("i") == 0, F.col("low")).otherwise(F.element_at("cuts", F.greatest("i", F.lit(1)))))
    parts = parts.withColumn("f", two_fattest("low", "depth"))
    return parts.select(
        "path", "level", "low", "depth", "f",
        F.element_at("hs", F.col("f")).alias("fh"), F.element_at("hs", F.col("depth")).alias("eh"), F.element_at("hs", F.col("low") + 1).alias("bh"),
        F.expr("slice(hs, low + 1, depth - low)").alias("edge"),
    )


def build(classes: DataFrame, first_batch: int = FIRST_BATCH, growth: int = GROWTH) -> tuple[DataFrame, DataFrame]:
    """The trie of distinct conversations as (paths, ends), both written; ``classes``: cid, u, whole, len, hs, chars."""
    spark = classes.sparkSession
    row = classes.agg(F.count(F.lit(1)).alias("n"), F.max("len").alias("longest")).first()
    n, longest = row["n"], row["longest"] or 0
    bounds = [first_batch]
    while bounds[-1] < n:
        bounds.append(bounds[-1] * growth)
    all_paths, all_ends = [], []
    for i, bound in enumerate(bounds):
        # u is uniform below 2^62 and drawn from the conversation's digest.
        from_, to = ((x << 62) // max(n, 1) for x in (bounds[i - 1] if i else 0, min(bound, n)))
        batch = classes.where((F.col("u") >= from_) & (F.col("u") < to if i < len(bounds) - 1 else F.lit(True)))
        size = min(bound, n)
        hot, shares = _hot_prefixes(batch, size), _shares(size)
        if all_paths:
            nodes = materialise(_nodes(_union(all_paths, spark, _PATHS), _union(all_ends, spark, _ENDS)), "trie-nodes")
            located = locate(batch, nodes, longest, hot, shares)
        else:
            located = batch.withColumns({"path": F.lit(ROOT).cast("long"), "level": F.lit(0), "depth": F.lit(0)})
        paths, ends = _insert(located, hot, shares)
        all_paths += paths
        all_ends += ends
    return materialise(_union(all_paths, spark, _PATHS), "trie-paths"), materialise(_union(all_ends, spark, _ENDS), "trie-ends")


_PATHS = "path long, parent long, level int, low int, len int, hs array<binary>, chars array<int>"
_ENDS = "cid long, path long, level int, depth int"


def _union(parts: list[DataFrame], spark: SparkSession, schema: str) -> DataFrame:
    out = spark.createDataFrame([], schema)
    for p in parts:
        out = out.unionByName(p)
    return out


def _id_digests(members: DataFrame) -> DataFrame:
    """(cid, ends_sha256): SHA-256 of the ids of each class, ascending and comma-joined.

    Ids are dealt by ranges, so a class that holds most of them is joined to texts in many tasks;
    only the texts of IDS_A_CHUNK ids each are hashed one after the other, as such a digest must be.
    """

    def join(batches: Iterator) -> Iterator:
        import pyarrow as pa

        cid, ids = None, []

        def rows(done):
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], k) for i, k in ((0, pa.int64()), (1, pa.int64()), (2, pa.string()))], names=["cid", "first", "ids"])

        for batch in batches:
            done = []
            for c, i in zip(batch["cid"].to_pylist(), batch["conv_id"].to_pylist()):
                if ids and (c != cid or len(ids) >= IDS_A_CHUNK):
                    done.append((cid, ids[0], ",".join(map(str, ids))))
                    ids = []
                cid = c
                ids.append(i)
            yield rows(done)
        if ids:
            yield rows([(cid, ids[0], ",".join(map(str, ids)))])

    def digest(batches: Iterator) -> Iterator:
        import pyarrow as pa

        cid, sha = None, None

        def rows(done):
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.int64()), pa.array([x[1] for x in done], pa.string())], names=["cid", "ends_sha256"])

        for batch in batches:
            done = []
            for c, ids in zip(batch["cid"].to_pylist(), batch["ids"].to_pylist()):
                if sha is None or c != cid:
                    if sha is not None:
                        done.append((cid, sha.hexdigest()))
                    cid, sha = c, hashlib.sha256(ids.encode())
                else:
                    sha.update(("," + ids).encode())
            yield rows(done)
        if sha is not None:
            yield rows([(cid, sha.hexdigest())])

    parts = max(1, members.sparkSession.sparkContext.defaultParallelism)
    texts = members.repartitionByRange(max(parts, int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "cid", "conv_id").sortWithinPartitions("cid", "conv_id").mapInArrow(join, "cid long, first long, ids string")
    return texts.repartition("cid").sortWithinPartitions("cid", "first").mapInArrow(digest, "cid long, ends_sha256 string")


def _expand(paths: DataFrame, ends: DataFrame) -> DataFrame:
    """One row per node below the root, from the paths of the last level up: path, depth, parent, low and the node's sums.

    ``ends`` has cid, path, level, depth and n (members of the class). Each level takes one shuffle of its own nodes.
    """
    spark = paths.sparkSession
    levels = paths.agg(F.max("level")).first()[0] or 0
    schema = "path long, depth int, n long, conv long, leaves long, saved long, paths long"
    heads, done = spark.createDataFrame([], schema), []
    of_end = ends.select("level", "path", "depth", "n", F.col("cid").alias("conv"), *(F.lit(0).cast("long").alias(c) for c in ("leaves", "saved", "paths")))
    down = Window.partitionBy("path").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for level in range(levels, 0, -1):
        own = paths.where(F.col("level") == level)
        events = heads.unionByName(of_end.where(F.col("level") == level).drop("level")).groupBy("path", "depth").agg(*(F.sum(c).alias(c) for c in ("n", "leaves", "saved", "paths")), F.min("conv").alias("conv"))
        points = own.select("path", "parent", "low", "len", F.posexplode(F.expr("slice(chars, low + 1, len - low)")).alias("i", "chars")).withColumn("depth", F.col("low") + F.col("i") + 1).drop("i")
        at = points.join(events, ["path", "depth"], "left").fillna(0, ["n", "leaves", "saved", "paths"])
        at = at.withColumns(
            {
                "n_convs": F.sum("n").over(down),
                "node_conv": F.min("conv").over(down),
                "n_children": F.col("paths") + (F.col("depth") < F.col("len")).cast("long"),
                "own_leaf": ((F.col("paths") == 0) & (F.col("depth") == F.col("len"))).cast("long"),
            }
        )
        at = at.withColumns(
            {
                "n_leaves": F.sum(F.col("leaves") + F.col("own_leaf")).over(down),
                "saved_tokens": F.sum(F.col("saved") + (F.col("n_convs") - 1) * F.col("chars")).over(down),
            }
        )
        kept = materialise(at.select("path", "depth", "parent", "low", F.col("node_conv").alias("conv"), "n_convs", "n_children", "n_leaves", "saved_tokens"), "trie-level")
        done.append(kept)
        heads = kept.where("depth = low + 1").select(
            F.col("parent").alias("path"), F.col("low").alias("depth"), F.col("n_convs").alias("n"), "conv", F.col("n_leaves").alias("leaves"),
            F.col("saved_tokens").alias("saved"), F.lit(1).cast("long").alias("paths"),
        )
    root = heads.unionByName(of_end.where("level = 0").drop("level"))
    root = root.agg(F.sum("n").alias("n_convs"), F.min("conv").alias("conv"), F.sum("paths").alias("n_children"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    root = root.where("n_convs IS NOT NULL").select(
        F.lit(ROOT).cast("long").alias("path"), F.lit(0).alias("depth"), F.lit(None).cast("long").alias("parent"), F.lit(None).cast("int").alias("low"),
        "conv", "n_convs", "n_children", F.greatest("n_leaves", F.lit(1).cast("long")).alias("n_leaves"), "saved_tokens",
    )
    out = root
    for d in done:
        out = out.unionByName(d)
    return materialise(out, "trie-expanded")


def prefix_trie(conversations: DataFrame, first_batch: int = FIRST_BATCH, growth: int = GROWTH) -> DataFrame:
    """One row per distinct prefix of the conversations (conv_id, turns as ``sequences`` gives them).

    conv_id (smallest member), depth, parent_conv_id, n_convs (members), n_children, n_leaves
    (childless nodes in the subtree), saved_tokens (over the subtree: members beyond the first times
    code points of the node's last text) and ends_sha256 (of the ids that end here, ascending and
    comma-joined). The root is the empty prefix, of which every conversation is a member, those without turns too.
    conv_ids must be distinct and not null, as those of ``sequences`` are; no conversations give no rows.

    A task holds the digests of one conversation's prefixes, 16 bytes a turn. Equal conversations are one
    class from the start, of which only ids and their number are kept.
    """
    all_ = materialise(conversations.select("conv_id", "turns").mapInArrow(_prefixes, "conv_id long, whole binary, hs array<binary>, chars array<int>"), "trie-conversations")
    keys = all_.groupBy("whole").agg(F.min("conv_id").alias("cid"), F.count(F.lit(1)).alias("n"))
    keys = materialise(keys, "trie-classes")
    u = F.shiftrightunsigned(F.xxhash64("whole"), 2)
    classes = all_.join(keys.select(F.col("cid").alias("conv_id")), "conv_id").select(F.col("conv_id").alias("cid"), u.alias("u"), "whole", F.size("hs").alias("len"), "hs", "chars")
    paths, ends = build(materialise(classes, "trie-distinct"), first_batch, growth)
    ends = ends.join(keys.select("cid", "n"), "cid")
    nodes = _expand(paths, ends)
    # The parent's smallest member: one depth above on the same path, or where the path leaves another.
    up = nodes.select("path", "depth", F.col("conv").alias("parent_conv_id"))
    begins = nodes.where("depth = low + 1").select("path", F.col("parent").alias("up"), F.col("low").alias("at"))
    inner = nodes.where("depth > low + 1").select("path", "depth", F.col("path").alias("up"), (F.col("depth") - 1).alias("at"))
    asked = inner.unionByName(begins.withColumn("depth", F.col("at") + 1))
    n = asked.count()
    counts = begins.groupBy("up", "at").agg(F.count(F.lit(1)).alias("n"))
    hot = counts.where(F.col("n") >= max(2, n // 1000)).select("up", "at")
    asked = spread_join(asked, up.withColumnsRenamed({"path": "up", "depth": "at"}), ["up", "at"], hot, "path", _shares(n))
    shas = _id_digests(members(all_, keys)).join(ends, "cid").select("path", "depth", "ends_sha256")
    out = nodes.join(asked.select("path", "depth", "parent_conv_id"), ["path", "depth"], "left").join(shas, ["path", "depth"], "left")
    return out.select(
        F.col("conv").alias("conv_id"),
        F.col("depth").cast("long").alias("depth"),
        "parent_conv_id",
        *(F.col(c).cast("long").alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def members(conversations: DataFrame, keys: DataFrame) -> DataFrame:
    """(cid, conv_id) of all conversations; the classes with very many members are joined by a broadcast of few keys."""
    n = conversations.count()
    hot = keys.where(F.col("n") >= max(2, n // 1000)).select("whole")
    return spread_join(conversations.select("whole", "conv_id"), keys.select("whole", "cid"), ["whole"], hot, "conv_id", _shares(n)).select("cid", "conv_id")
