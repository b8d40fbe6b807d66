"""Near duplicates among embeddings by an inverted multi-index.

The halves of the unit vectors have codebooks of their own, fitted on a bounded sample; the pairs
of codes are the cells of a product grid. Every vector lies in one cell and visits the cells
nearest to it, in the order of a multi-sequence traversal over both halves, until the target recall
is reached; there it is held against the vectors that lie in them, with exact cosines.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabcast.llm.common import components, materialise, shares, spread_join

#: The codebooks are fitted on at most so many vectors, those of smallest hash; all are indexed.
SAMPLE = 8192
CODES = 32
TARGET_RECALL = 0.999
#: Vectors of a cell that one task holds against its visitors.
BLOCK = 4096


def valid_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the rows with an id and a vector that is neither null, empty nor zero and all finite; v as floats or doubles."""
    kind = "array<float>" if dict(rows.dtypes)[vector_col] == "array<float>" else "array<double>"
    v = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(kind).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.where(F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))


def number_type(v: DataFrame) -> str:
    """numpy's name for the numbers of ``v``, which travel as they are and are computed with as doubles."""
    return "<f4" if dict(v.dtypes)["v"] == "array<float>" else "<f8"


def packed(v: DataFrame) -> DataFrame:
    """``v`` with the vector as the bytes of its numbers, as numpy reads them."""
    kind = number_type(v)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            cols = {c: batch[c] for c in batch.schema.names}
            cols["v"] = pa.array([np.asarray(x, dtype=kind).tobytes() for x in cols["v"].to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return v.mapInArrow(run, ", ".join(f"{c} {'binary' if c == 'v' else t}" for c, t in v.dtypes))


def unpacked(vectors, kind: str):
    """A matrix of doubles from the bytes of vectors of one length."""
    import numpy as np

    return np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1).astype(float)


def codes_for(vectors: int) -> int:
    """Codes of each half, so that a cell of the grid has about BLOCK vectors at any size, CODES at least."""
    return max(CODES, math.isqrt(vectors // BLOCK))


def _codebook(x, codes: int, rounds: int = 12):
    """k-means centres of the rows of ``x``; starts are spread over the rows, so reruns agree."""
    import numpy as np

    codes = min(codes, len(x))
    c = x[np.linspace(0, len(x) - 1, codes).astype(int)].copy()
    for _ in range(rounds):
        near = np.argmin((c * c).sum(1) - 2 * x @ c.T, axis=1)
        for k in range(codes):
            if (near == k).any():
                c[k] = x[near == k].mean(0)
    return c


def effective_rank(x) -> float:
    """In how many directions the rows of ``x`` spread: the number of equal eigenvalues that would have the same sum and sum of squares."""
    import numpy as np

    c = x.T @ x
    squares = (c * c).sum()
    return float(np.trace(c) ** 2 / squares) if squares > 0 else 1.0


def fit_codebooks(vectors: DataFrame, kind: str, sample: int = SAMPLE, codes: int = CODES) -> dict[int, tuple]:
    """Codebooks of the first and the second half and the effective rank, for each length in bytes in the sample."""
    rows = vectors.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").collect()
    by_size: dict[int, list] = {}
    for r in rows:
        by_size.setdefault(len(r["v"]), []).append(r["v"])
    books = {}
    for size, x in by_size.items():
        x = _unit(unpacked(x, kind))
        half = (x.shape[1] + 1) // 2
        books[size] = (_codebook(x[:, :half], codes), _codebook(x[:, half:], codes), effective_rank(x - x.mean(0)))
    return books


def _unit(x):
    import numpy as np

    # Scaled first, so that squares of very small or large components neither vanish nor overflow.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _margins(x, book):
    """(code of each row, squared distance of each row to each code's region, at least)."""
    import numpy as np

    d = (x * x).sum(1)[:, None] + (book * book).sum(1) - 2 * x @ book.T
    home = np.argmin(d, axis=1)
    apart = np.sqrt(np.maximum(((book[:, None] - book[None]) ** 2).sum(2), 1e-300))
    gap = np.maximum(d - d[np.arange(len(x)), home][:, None], 0) / (2 * apart[home])
    gap[np.arange(len(x)), home] = 0
    return home, gap * gap


def multi_sequence(first: list[tuple[float, int]], second: list[tuple[float, int]], limit: float) -> Iterator[tuple[int, int]]:
    """Cells (i, j) in the order of the sum of the two sorted costs, while that is within ``limit``."""
    heap, seen = [(first[0][0] + second[0][0], 0, 0)], {(0, 0)}
    while heap:
        cost, a, b = heapq.heappop(heap)
        if cost > limit:
            return
        yield first[a][1], second[b][1]
        for x, y in ((a + 1, b), (a, b + 1)):
            if x < len(first) and y < len(second) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (first[x][0] + second[y][0], x, y))


def visit_limit(rank: float, cosine: float, recall: float) -> float:
    """How far, squared, a visitor goes into other regions.

    A vector within the cosine differs by at most sqrt(2 - 2 * cosine). If its direction is any of the
    ``rank`` in which the vectors spread, the parts of the difference across the nearest border in each
    half have, together, a chi-square law of two degrees, scaled by the rank: this is its quantile of ``recall``.
    """
    if recall >= 1:
        return 2 - 2 * cosine
    return min((2 - 2 * cosine) * -2 * math.log(1 - recall) / max(rank, 1), 2 - 2 * cosine)


def _cells(vectors: DataFrame, books, kind: str, cosine: float, recall: float, blocks: dict[str, int] | None) -> DataFrame:
    """(cell, block, side, id, n, v): where each vector lies (side 0), and where it is held against others.

    A vector visits its own cell (side 1) and, of the cells within its limit, those after its own
    (side 2), so that each pair of cells meets once. ``blocks`` has the number of blocks of large
    cells. Without it only the places (side 0) are made.
    """
    shared = vectors.sparkSession.sparkContext.broadcast((books, blocks or {}))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash

        own_books, many = shared.value

        def batch_of(rows):
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            cols = list(zip(*rows)) or [()] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["cell", "block", "side", "id", "n", "v"])

        def place(out, row, home, visits):
            out.append((home, xxhash.xxh32_intdigest(row[0].to_bytes(8, "little", signed=True)) % many.get(home, 1), 0, *row))
            if blocks is not None:
                out += [(cell, b, 1 if cell == home else 2, *row) for cell in visits for b in range(many.get(cell, 1))]

        for batch in batches:
            out, by_size = [], {}
            for row in zip(batch["id"].to_pylist(), batch["n"].to_pylist(), batch["v"].to_pylist()):
                by_size.setdefault(len(row[2]), []).append(row)
            for size, rows in by_size.items():
                if size not in own_books:  # a length that the sample lacks: one cell holds them all
                    for row in rows:
                        place(out, row, f"{size}", [f"{size}"])
                    continue
                x = _unit(unpacked([r[2] for r in rows], kind))
                half, limit = (x.shape[1] + 1) // 2, visit_limit(own_books[size][2], cosine, recall)
                homes, sides = [], []
                for part, book in zip((x[:, :half], x[:, half:]), own_books[size][:2]):
                    home, gap = _margins(part, book)
                    order = np.argsort(gap, axis=1, kind="stable")
                    homes.append(home.tolist())
                    sides.append((order, np.take_along_axis(gap, order, axis=1), (gap <= limit).sum(1)))
                for i, row in enumerate(rows):
                    own = (homes[0][i], homes[1][i])
                    a, b = (list(zip(gap[i, : n[i]].tolist(), order[i, : n[i]].tolist())) for order, gap, n in sides)
                    visits = [] if blocks is None else [c for c in multi_sequence(a, b, limit) if c >= own]
                    place(out, row, f"{size}:{own[0]}:{own[1]}", [f"{size}:{c[0]}:{c[1]}" for c in visits])
                    if len(out) > 5000:
                        yield batch_of(out)
                        out = []
            yield batch_of(out)

    return vectors.mapInArrow(run, "cell string, block int, side int, id long, n long, v binary")


def _merge(label, near):
    """Smaller labels for residents that a visitor of ``near`` (visitors × residents) links; equal labels stay equal."""
    import numpy as np

    none = len(label)
    linked = near.any(axis=0)
    if not linked.any():
        return label
    near = near[near.any(axis=1)][:, linked]
    while True:
        mine = label[linked]
        least = np.where(near, mine, none).min(axis=1)
        new = np.minimum(mine, np.where(near, least[:, None], none).min(axis=0))
        if (new == mine).all():
            return label
        to = np.arange(none + 1)
        np.minimum.at(to, mine, new)
        while (to[to] != to).any():
            to = to[to]
        label = to[label]


def _links_in_cells(cosine: float, kind: str, chunk: int = 512):
    """From rows sorted by (cell, block, side) to (id, n_links, root): links counted, and links that join all that reach each other.

    The residents of a block come first, a bounded number; visitors stream past them in chunks. A visitor is
    joined to one of the residents it links, and residents that visitors link are joined among themselves at
    the end of the block, so a task holds a block and a chunk however many visitors come and however many link.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def rows(ids, links, roots):
            return pa.RecordBatch.from_arrays([pa.array(np.asarray(c, dtype=np.int64)) for c in (ids, links, roots)], names=["id", "n_links", "root"])

        key, home, state = None, [], None

        def settle():
            """The block's residents as arrays, once the first visitor comes."""
            y = unpacked([r[2] for r in home], kind)
            return {"y": y, "norm": np.linalg.norm(y, axis=1), "id": np.array([r[0] for r in home]), "n": np.array([r[1] for r in home]), "label": np.arange(len(home)), "links": np.zeros(len(home), np.int64)}

        def visit(part):
            x, x_id, x_n = unpacked([r[2] for r in part], kind), np.array([r[0] for r in part]), np.array([r[1] for r in part])
            near = (x @ state["y"].T) / (np.linalg.norm(x, axis=1)[:, None] * state["norm"]) >= cosine
            near &= x_id[:, None] != state["id"]
            # Visitors of other cells are links of those who live here; neighbours in the cell visit each other.
            state["links"] += (x_n * np.array([r[3] == 2 for r in part])) @ near
            state["label"] = _merge(state["label"], near)
            some = near.any(axis=1)
            return rows(x_id[some], (near @ state["n"])[some], state["id"][near.argmax(axis=1)][some])

        def leave():
            if state is None:
                return rows([], [], [])
            return rows(state["id"], state["links"], state["id"][state["label"]])

        for batch in batches:
            visitors = []
            for cell, block, side, *row in zip(*(batch[c].to_pylist() for c in ("cell", "block", "side", "id", "n", "v"))):
                if (cell, block) != key:
                    if visitors:
                        yield visit(visitors)
                        visitors = []
                    if key is not None:
                        yield leave()
                    key, home, state = (cell, block), [], None
                if side == 0:
                    home.append(row)
                    continue
                if not home:
                    continue  # nobody lives here
                state = state or settle()
                visitors.append((*row, side))
                if len(visitors) == chunk:
                    yield visit(visitors)
                    visitors = []
            if visitors:
                yield visit(visitors)
        if key is not None:
            yield leave()

    return run


def near_duplicates(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.95, recall: float = TARGET_RECALL, block: int = BLOCK
) -> DataFrame:
    """Per row: id, n_links (other vectors linked with it), component_id, kept.

    Vectors link if their cosine, in double precision, is at least ``cosine``; pairs are sought by a
    traversal that finds a share of about ``recall`` of them, all of them if it is 1. Vectors
    that are null, empty, zero or hold null or non-finite components, and rows with a null id, link
    with nothing; nor do vectors of different lengths. Copies of a vector are compared once. Rows
    that repeat an id with the same vector are that one vector; ids should not repeat with others.
    An empty table gives no rows. Extra columns are ignored.
    """
    v = valid_vectors(rows, id_col, vector_col).distinct()
    kind = number_type(v)
    classes = v.groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    classes = materialise(packed(classes.select("id", "n", "v")), "dedup-vectors")
    count = classes.count()
    books = fit_codebooks(classes, kind, codes=codes_for(count))
    # A cell of very many vectors is cut into blocks, and visitors come to each; there is one such cell per ``block`` vectors at most.
    places = _cells(classes, books, kind, cosine, recall, None).groupBy("cell").agg(F.count(F.lit(1)).alias("size"))
    blocks = {r["cell"]: -(-r["size"] // block) for r in places.where(F.col("size") > block).collect()}
    cells = _cells(classes, books, kind, cosine, recall, blocks)
    dealt = cells.repartition("cell", "block").sortWithinPartitions("cell", "block", "side", "id")
    links = materialise(dealt.mapInArrow(_links_in_cells(cosine, kind), "id long, n_links long, root long"), "dedup-links")
    roots = components(links.where("id <> root"), "id", "root")
    counts = links.groupBy("id").agg(F.sum("n_links").alias("n_links"))
    found = classes.select("id", "n").join(counts, "id", "left").join(roots.withColumnRenamed("node", "id"), "id", "left")
    found = found.select(
        F.col("id").alias("class"), (F.coalesce("n_links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "id").alias("component_id")
    )
    # Rows find their class by 128 bits of hashes; a vector that very many rows share is dealt over many tasks.
    hashes = [F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2")]
    by_hash = v.groupBy(*hashes).agg(F.min("id").alias("class"), F.count(F.lit(1)).alias("n"))
    by_hash = materialise(by_hash, "dedup-classes")
    total = by_hash.agg(F.sum("n")).first()[0] or 0
    hot = by_hash.where(F.col("n") >= max(2, total // 1000)).select("h1", "h2")
    members = spread_join(v.select("id", *hashes), by_hash.drop("n"), ["h1", "h2"], hot, "id", shares(total))
    named = members.select("id", "class").join(found, "class").groupBy("id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    out = rows.select(F.col(id_col).cast("long").alias("row_id")).join(named, F.col("row_id") == F.col("id"), "left")
    component = F.coalesce("component_id", "row_id")
    return out.select(
        F.col("row_id").alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("row_id") == component).alias("kept"),
    )
