"""Near-duplicate vectors: spherical k-means cells and blocked cosine products (operator 4).

Equal vectors are one node with a count, so copies are never compared. Centroids are fitted on a bounded
sample; every vector x has a home cell, of centroid h, and also visits each cell c with
x(h - c) <= |h - c| sqrt(2 - 2 threshold) / 2. In each cell the vectors at home are compared with all that visit, block by block in double precision; a
block pair hands out a count and one link for each vector at most. Hot cells are split into blocks of
bounded size by hash. A pair that two cells see is counted in the lower one.

No pair is missed, however the centroids lie: for x at home in h and y in c, x(h - c) + y(c - h) = (x - y)(h - c)
is at most |x - y| |h - c|, and |x - y| at most sqrt(2 - 2 threshold), so one of the two visits the other's home.

Null, empty and zero vectors and vectors with null or non-finite components link with nothing, nor do vectors of
different lengths. Repeated rows are vectors of their own. A null id has kept = false. An empty table gives
an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from paddock.llm.common import components, forest
from paddock.session import cut_lineage

THRESHOLD = 0.9
SLACK = 1e-7  # for rounding: a vector rather visits a cell too many
MOST_CELLS = 4096
SAMPLE_PER_CELL = 16  # so at most 65,536 vectors for the fit
ROUNDS = 8
BLOCK = 2048
SEED = 11


def usable(vector: str) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(rows):
    """Rows scaled to length 1 in double precision; no overflow for large components."""
    import numpy as np

    rows = np.asarray(rows, np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def spherical_kmeans(rows, cells: int, rounds: int = ROUNDS, seed: int = SEED):
    """Unit centroids of unit rows; an empty cell keeps its centroid."""
    import numpy as np

    rng = np.random.default_rng(seed)
    centroids = rows[rng.choice(len(rows), min(cells, len(rows)), replace=False)]
    for _ in range(rounds):
        home = np.concatenate([(rows[i : i + 4096] @ centroids.T).argmax(axis=1) for i in range(0, len(rows), 4096)])
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, rows)
        length = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centroids = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), centroids)
    return centroids


def cells_of(rows, centroids, reach: float):
    """Home cell of each unit row, and whether it visits each cell; ``reach`` is half the largest distance of a linked pair."""
    import numpy as np

    likeness = rows @ centroids.T
    home = likeness.argmax(axis=1)
    homes, at = np.unique(home, return_inverse=True)
    squares = (centroids * centroids).sum(axis=1)
    apart = np.sqrt(np.maximum(squares[homes, None] + squares - 2 * (centroids[homes] @ centroids.T), 0))
    return home, likeness.max(axis=1, keepdims=True) - likeness <= reach * apart[at] + SLACK


def near_duplicates(df: DataFrame, id_column: str, vector: str, threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_links, component_id, kept) of each row."""
    rows = df.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{vector}`").alias("vector"))
    good = rows.where(usable("vector"))
    nodes = good.groupBy("vector").agg(F.count("*").alias("copies"), F.min("id").alias("least"))
    nodes = cut_lineage(nodes.withColumn("node", F.monotonically_increasing_id()))
    cells = min(MOST_CELLS, math.ceil(math.sqrt(nodes.count())))
    sample = nodes.orderBy(F.xxhash64("vector"), "node").limit(max(1, cells * SAMPLE_PER_CELL)).select("vector").toPandas()["vector"]
    model = {}
    for length in {len(v) for v in sample}:
        model[length] = spherical_kmeans(unit([v for v in sample if len(v) == length]), cells)
    spread = nodes.sparkSession.sparkContext.broadcast(model)  # at most MOST_CELLS centroids for each length
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) / 2
    kind = "<f4" if rows.schema["vector"].dataType.elementType.typeName() == "float" else "<f8"  # vectors travel as they came

    def visit(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            node, copies = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            vectors = batch.column(2)
            start = vectors.offsets.to_numpy()
            lengths, flat = np.diff(start), vectors.values.to_numpy(zero_copy_only=False)
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                raw = flat[start[at][:, None] + np.arange(length)]
                centroids = spread.value.get(int(length))
                for i in range(0, len(at), 1024):
                    part, some = at[i : i + 1024], unit(raw[i : i + 1024])
                    # no vector of this length in the sample: one cell
                    home, visited = cells_of(some, np.zeros((1, length)) if centroids is None else centroids, reach)
                    who, cell = np.nonzero(visited)
                    cuts = np.searchsorted(who, np.arange(1, len(part)))
                    visits = [v.tobytes() for v in np.split(cell.astype("<i4"), cuts)]
                    data = [v.tobytes() for v in raw[i : i + 1024].astype(kind)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(who), length, np.int32)),
                            pa.array(cell.astype(np.int32)),
                            pa.array(home[who].astype(np.int32)),
                            pa.array(node[part][who]),
                            pa.array(copies[part][who]),
                            pa.array([visits[w] if h else None for w, h in zip(who, home[who] == cell)], pa.binary()),  # only asked of those at home
                            pa.array([data[w] for w in who], pa.binary()),
                        ],
                        names=["length", "cell", "home", "node", "copies", "visits", "raw"],
                    )

    schema = "length int, cell int, home int, node long, copies long, visits binary, raw binary"
    visitors = nodes.select("node", "copies", "vector").mapInArrow(visit, schema)
    at_home = F.col("home") == F.col("cell")
    blocks = lambda n: F.greatest(F.lit(1), F.ceil(n / BLOCK)).cast("int")
    sizes = visitors.drop("raw", "visits").groupBy("length", "cell").agg(
        blocks(F.sum(at_home.cast("int"))).alias("left_blocks"), blocks(F.count("*")).alias("right_blocks")
    )
    sized = visitors.join(cut_lineage(sizes), ["length", "cell"])
    block = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = sized.where(at_home).withColumns({"left": block("left_blocks"), "right": all_of("right_blocks"), "side": F.lit(0)})
    right = sized.withColumns({"right": block("right_blocks"), "left": all_of("left_blocks"), "side": F.lit(1)})

    def compare(frame):
        import numpy as np
        import pandas as pd

        sides = [frame[frame["side"] == side].reset_index(drop=True) for side in (0, 1)]
        out = pd.DataFrame({"node": [], "links": [], "root": []}, dtype="int64")
        if not len(sides[0]) or not len(sides[1]):
            return out
        a, b = sides
        cell = int(a["cell"].iloc[0])
        matrix = [unit(np.frombuffer(b"".join(s["raw"]), kind).reshape(len(s), -1)) for s in sides]
        ids, many, home = [s["node"].to_numpy() for s in sides], [s["copies"].to_numpy() for s in sides], b["home"].to_numpy()
        seen = [frozenset(np.frombuffer(v, "<i4").tolist()) for v in a["visits"]]
        pairs = [np.empty((0, 2), np.int64)]
        for start in range(0, len(a), 256):
            near = np.argwhere(matrix[0][start : start + 256] @ matrix[1].T >= threshold)
            near[:, 0] += start
            x, y = near[:, 0], near[:, 1]
            own = (home[y] == cell) & (ids[0][x] < ids[1][y])
            other = home[y] != cell
            # seen by the lower cell too, which counts it
            other[other] = [not (h < cell and h in seen[i]) for i, h in zip(x[other].tolist(), home[y[other]].tolist())]
            pairs.append(near[own | other])
        pairs = np.concatenate(pairs)
        if not len(pairs):
            return out
        x, y = pairs[:, 0], pairs[:, 1]
        found, at = np.unique(np.concatenate([ids[0][x], ids[1][y]]), return_inverse=True)
        links = np.bincount(at, np.concatenate([many[1][y], many[0][x]]), len(found)).astype(np.int64)
        root = forest(at[: len(x)], at[len(x) :], len(found))
        return pd.DataFrame({"node": found, "links": links, "root": found[root]})

    columns = ["length", "cell", "left", "right", "side", "home", "node", "copies", "visits", "raw"]
    pairs = left.select(columns).union(right.select(columns)).groupBy("length", "cell", "left", "right")
    linked = cut_lineage(pairs.applyInPandas(compare, "node long, links long, root long"))
    roots = components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")).where("a <> b").distinct())
    known = nodes.join(linked.groupBy("node").agg(F.sum("links").alias("links")), "node", "left").join(roots, "node", "left")
    known = known.select("vector", "least", F.coalesce("root", "node").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    known = cut_lineage(known)
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(least, "root").select("vector", "n_links", "component_id")
    linked_rows = good.join(known, "vector").select("id", "n_links", "component_id")
    alone = rows.where(~usable("vector")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    both = linked_rows.union(alone)
    return both.select(F.col("id").alias(id_column), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
