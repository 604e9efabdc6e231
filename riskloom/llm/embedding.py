"""Near-duplicate vectors by a robustly pruned flat graph."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.llm.components import components
from riskloom.llm.prefix import partitions
from riskloom.session import stage

#: Vectors that the cluster centres of each dimension are fitted on, at most.
SAMPLE = 20_000
#: Vectors per cluster aimed at, and centres at most; larger clusters are cut into blocks.
CLUSTER = 1_000
CENTRES = 1_024
FIT_ROUNDS = 8
#: Vectors of a shard in one block; a block's graph is built and searched by one task.
BLOCK = 4_000
#: Out-degree after pruning, width of the beam, and the pruning's slack.
DEGREE = 24
BEAM = 32
ALPHA = 1.2
ENTRIES = 4
THRESHOLD = 0.9
#: A vector is a row of its nearest centre's shard and asks in each shard whose boundary is near.
#: Along a boundary's normal, vectors at the threshold lie apart by the threshold's sine times a
#: factor that in many dimensions is about normal with a deviation of 1 / sqrt(dimension - 1);
#: the margins tried are so many deviations wide, the last covers every direction.
MARGINS = (3.0, 4.0, 5.0, float("inf"))
#: Queries per task whose links are also counted by comparing with the whole block, and the share
#: of links to be found; a task below it compares all its queries with the whole block.  The same
#: share of the links of the audited vectors (ids divisible by 100) is to be found in the table.
AUDITED = 8
RECALL = 0.99


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_centres(sample: np.ndarray, wanted: int) -> np.ndarray:
    """Spherical k-means on unit vectors, from evenly spaced rows of the sample."""
    wanted = max(1, min(wanted, CENTRES, len(sample)))
    centres = sample[np.linspace(0, len(sample) - 1, wanted).astype(int)].copy()
    for _ in range(FIT_ROUNDS if wanted > 1 else 1):
        home = np.concatenate([(part @ centres.T).argmax(1) for part in np.array_split(sample, max(1, len(sample) // 2000))])
        sums = np.zeros_like(centres)
        np.add.at(sums, home, sample)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 1e-9, sums / np.maximum(norms, 1e-9), centres)
    return centres


def assign(x: np.ndarray, centres: np.ndarray, margin: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """The nearest centre of each unit vector, and the centres it asks in, the nearest among them:
    those whose boundary with the nearest one is at most ``margin`` away."""
    near = x @ centres.T
    home = near.argmax(axis=1)
    apart = np.linalg.norm(centres[:, None] - centres[None], axis=2) if len(centres) < 64 else np.sqrt(
        np.maximum((centres**2).sum(1)[:, None] + (centres**2).sum(1) - 2 * centres @ centres.T, 0)
    )
    # equal centres have no boundary between them
    asked = near[np.arange(len(x)), home][:, None] - near <= margin * apart[home] + 1e-9
    asked[np.arange(len(x)), home] = True
    return home, [np.flatnonzero(a) for a in asked]


def margin_of(deviations: float, dimension: int, threshold: float) -> float:
    """Distance from a boundary up to which a vector asks on its other side."""
    widest = float(np.sqrt(max(1 - threshold * threshold, 0)))
    return widest * min(1.0, deviations / np.sqrt(max(dimension - 1, 1)))


def _prune(x: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Robust pruning for all rows at once: nearest first, dropping what a chosen one covers.

    ``candidates[i]`` are row numbers, -1 for none.  A candidate is covered by a chosen one if it is
    ``ALPHA`` times nearer to that than to row i.
    """
    n, width = candidates.shape
    out = np.full((n, DEGREE), -1)
    for start in range(0, n, 512):
        mine = slice(start, min(start + 512, n))
        c = candidates[mine]
        own = np.arange(mine.start, mine.stop)
        y = x[np.maximum(c, 0)]
        far = np.maximum(2 - 2 * (y @ x[mine][:, :, None])[:, :, 0], 0)
        # none, itself and repeats are put last
        order = np.argsort(c, axis=1, kind="stable")
        sorted_c = np.take_along_axis(c, order, 1)
        again = np.zeros_like(c, bool)
        np.put_along_axis(again, order[:, 1:], sorted_c[:, 1:] == sorted_c[:, :-1], 1)
        alive = (c >= 0) & (c != own[:, None]) & ~again
        far = np.where(alive, far, np.inf)
        between = np.maximum(2 - 2 * (y @ y.swapaxes(1, 2)), 0)
        rows = np.arange(len(c))
        for k in range(DEGREE):
            best = np.where(alive, far, np.inf).argmin(axis=1)
            there = alive[rows, best]
            if not there.any():
                break
            out[mine.start + rows[there], k] = c[rows[there], best[there]]
            covered = ALPHA * ALPHA * between[rows, best] <= far
            alive &= ~(covered & there[:, None])
            alive[rows, best] = False
    return out


def _search(x: np.ndarray, graph: np.ndarray, queries: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Greedy search with a beam for many queries at once; the beam's rows, nearest first."""
    out = np.empty((len(queries), BEAM), np.int64)
    for start in range(0, len(queries), 512):
        q = queries[start : start + 512]
        n = len(q)
        rows = np.arange(n)[:, None]
        beam = np.full((n, BEAM), -1)
        score = np.full((n, BEAM), -np.inf, np.float32)
        beam[:, : len(entries)] = entries
        score[:, : len(entries)] = q @ x[entries].T
        seen = np.zeros((n, len(x) + 1), bool)  # the last column stands for no neighbour
        seen[:, entries] = True
        seen[:, -1] = True
        open_ = beam >= 0
        while True:
            pick = np.where(open_, score, -np.inf).argmax(axis=1)
            active = open_[np.arange(n), pick]
            if not active.any():
                break
            at = np.flatnonzero(active)
            open_[at, pick[at]] = False
            near = graph[beam[at, pick[at]]]
            new = ~seen[at[:, None], near]
            seen[at[:, None], near] = True
            close = np.where(new, (x[np.maximum(near, 0)] @ q[at][:, :, None])[:, :, 0], -np.inf)
            all_score = np.concatenate([score[at], close], axis=1)
            all_beam = np.concatenate([beam[at], np.where(new, near, -1)], axis=1)
            all_open = np.concatenate([open_[at], new], axis=1)
            best = np.argpartition(-all_score, BEAM - 1, axis=1)[:, :BEAM]
            score[at] = np.take_along_axis(all_score, best, 1)
            beam[at] = np.take_along_axis(all_beam, best, 1)
            open_[at] = np.take_along_axis(all_open, best, 1) & (beam[at] >= 0)
        order = np.argsort(-score, axis=1, kind="stable")
        out[start : start + n] = beam[rows, order]
    return out


def entry_points(x: np.ndarray) -> np.ndarray:
    """The medoid, and the medoids of quarters of the block cut by distance from it."""
    mean = x.mean(axis=0)
    medoid = int((x @ mean).argmax())
    order = np.argsort(-(x @ x[medoid]), kind="stable")
    found = [medoid]
    for part in np.array_split(order, ENTRIES):
        if len(part):
            found.append(int(part[(x[part] @ x[part].mean(axis=0)).argmax()]))
    return np.array(sorted(set(found)))


def build_graph(x: np.ndarray, seed: int = 1) -> np.ndarray:
    """Pruned out-neighbours of each row, -1 for none, from a random graph and two passes.

    A pass searches every row in the graph so far, prunes what the beam met together with the
    row's neighbours, and gives chosen neighbours a link back, pruned again.
    """
    n = len(x)
    random = np.random.default_rng(seed)
    graph = random.integers(0, n, (n, min(DEGREE, max(n - 1, 1))))
    graph = _prune(x, np.pad(graph, ((0, 0), (0, max(0, DEGREE - graph.shape[1]))), constant_values=-1))
    entries = entry_points(x)
    for _ in range(2):
        met = _search(x, graph, x, entries)
        graph = _prune(x, np.concatenate([met, graph], axis=1))
        graph = _prune(x, np.concatenate([graph, _back_links(graph)], axis=1))
    return graph


def _back_links(graph: np.ndarray, width: int = 2 * DEGREE) -> np.ndarray:
    """Rows that link to each row, ``width`` of them, evenly chosen where there are more."""
    n = len(graph)
    source, slot = np.nonzero(graph >= 0)
    target = graph[source, slot]
    order = np.lexsort((source, target))
    source, target = source[order], target[order]
    counts = np.bincount(target, minlength=n)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    place = np.arange(len(target)) - first[target]
    # spread what does not fit: every (counts / width)-th link is taken
    ratio = np.maximum(counts / width, 1.0)[target]
    taken = np.floor(place / ratio).astype(int)
    keep = (place == np.ceil(taken * ratio).astype(int)) & (taken < width)
    out = np.full((n, width), -1)
    out[target[keep], taken[keep]] = source[keep]
    return out


def _both_ways(graph: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of the graph in both directions: per row its first place in the list of targets."""
    source, slot = np.nonzero(graph >= 0)
    target = graph[source, slot]
    ends = np.concatenate([source, target])
    targets = np.concatenate([target, source])[np.argsort(ends, kind="stable")]
    return np.concatenate([[0], np.cumsum(np.bincount(ends, minlength=len(graph)))]), targets


def range_search(
    x: np.ndarray,
    graph: np.ndarray,
    exact: np.ndarray,
    queries: np.ndarray,
    own: np.ndarray,
    entries: np.ndarray,
    threshold: float,
) -> Iterator[tuple[int, np.ndarray]]:
    """For each query its rows of ``x`` with cosine of ``threshold`` or more, verified in double.

    Greedy search brings a query to its nearest rows; from those in range the search goes on to
    all their neighbours as long as it meets new rows in range.  The rows of the beam that are
    nearest but out of range are opened too, as the way into the range may lead past them.
    """
    single = queries.astype(np.float32)
    beams = _search(x, graph, single, entries)
    margin = np.float32(threshold - 1e-4)
    first, targets = _both_ways(graph)
    for i, beam in enumerate(beams):
        front = np.unique(np.append(beam, own[i]))
        front = front[front >= 0]
        seen = np.zeros(len(x), bool)
        seen[front] = True
        found = front[x[front] @ single[i] >= margin]
        front = found
        while len(front):
            many = first[front + 1] - first[front]
            skipped = np.repeat(first[front] - np.cumsum(many) + many, many)
            near = np.unique(targets[skipped + np.arange(len(skipped))])
            near = near[~seen[near]]
            seen[near] = True
            front = near[x[near] @ single[i] >= margin]
            found = np.concatenate([found, front])
        yield i, found[exact[found] @ queries[i] >= threshold]


def _rows(column: pa.Array) -> np.ndarray:
    """A list column of one length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(len(column), -1)


def _usable(column: str):
    """Whether a vector has numbers only, and one that is not 0."""
    good = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good & F.exists(column, lambda x: x != 0), F.lit(False))


def _centres(nodes: DataFrame) -> dict[int, np.ndarray]:
    """Centres per dimension, fitted on the vectors of smallest id hash."""
    found = {}
    for dimension, n in nodes.groupBy("dim").count().collect():
        sample = nodes.filter(F.col("dim") == dimension).orderBy(F.xxhash64("node")).limit(SAMPLE)
        table = sample.select("vector").toArrow()
        x = _unit(np.concatenate([_rows(c) for c in table.column(0).chunks]))
        found[dimension] = fit_centres(x, -(-n // CLUSTER))
    return found


def _shards(nodes: DataFrame, centres: dict[int, np.ndarray], deviations: float, threshold: float) -> DataFrame:
    """Each node with its ``shard`` (the nearest centre's) and the ``shards`` it asks in."""
    columns = ["dim", "node", "weight", "vector"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(0).to_numpy()
            for dimension in np.unique(dims):
                part = batch.filter(pa.array(dims == dimension))
                margin = margin_of(deviations, int(dimension), threshold)
                home, asked = assign(_unit(_rows(part.column(3))), centres[int(dimension)], margin)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(home.astype(np.int32)), pa.array([a.astype(np.int32) for a in asked], pa.list_(pa.int32()))],
                    [*columns, "shard", "shards"],
                )

    schema = "dim int, node long, weight long, vector array<double>, shard int, shards array<int>"
    return stage(nodes.select(*columns).mapInArrow(place, schema), "vector-shards")


def _in_parts(rows: DataFrame, part: str, parts: str) -> DataFrame:
    """Add the block of each row of a shard and the number of blocks."""
    sizes = rows.groupBy("dim", "shard").agg(F.ceil(F.count("node") / BLOCK).cast("int").alias(parts))
    # one row per dimension and centre, of which there are at most CENTRES
    rows = rows.join(F.broadcast(sizes), ["dim", "shard"])
    return rows.withColumn(part, F.pmod(F.xxhash64("node"), F.col(parts)).cast("int"))


def _by_key(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Rows of sorted batches, one table per value of the first columns."""
    held: list[pa.RecordBatch] = []
    key: tuple | None = None
    for batch in batches:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = [0, *np.flatnonzero(change), batch.num_rows]
        for a, b in zip(starts, starts[1:], strict=False):
            if a == b:
                continue
            now = tuple(c[a].item() for c in columns)
            if now != key and held:
                yield key, pa.Table.from_batches(held)
                held = []
            key = now
            held.append(batch.slice(a, b - a))
    if held:
        yield key, pa.Table.from_batches(held)


def _one(table: pa.Table, name: str):
    return table.column(name).combine_chunks()


def _graph(placed: DataFrame) -> DataFrame:
    """The flat graph: per node its neighbours in its block's graph; stored."""
    order = ["dim", "shard", "part"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in _by_key(batches, 3):
            nodes = _one(table, "node").to_numpy()
            x = _unit(_rows(_one(table, "vector"))).astype(np.float32)
            graph = build_graph(x) if len(x) > 1 else np.full((len(x), 1), -1)
            near = [nodes[g[g >= 0]] for g in graph]
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(near, pa.list_(pa.int64()))], ["node", "near"])

    rows = _in_parts(placed, "part", "parts").select(*order, "node", "vector")
    built = rows.repartition(partitions(rows), *order).sortWithinPartitions(*order)
    return stage(built.mapInArrow(build, "node long, near array<long>"), "vector-graph")


def _found(placed: DataFrame, graph: DataFrame, threshold: float) -> DataFrame:
    """Links of the nodes: ``u, v`` that connect, and ``u, n`` counts; stored.

    Each block of a shard is searched by each block of queries that ask in the shard.  A node is a
    row of one shard, so a query meets it once; if the row does not ask in the query's shard, the
    link counts for the row as well.
    """
    order = ["dim", "shard", "query_part", "part"]
    data = _in_parts(placed, "part", "parts").withColumn("home", F.col("shard"))
    asking = placed.withColumn("home", F.col("shard")).withColumn("shard", F.explode("shards"))
    asking = _in_parts(asking, "query_part", "query_parts")
    blocks = data.select("dim", "shard", "parts").distinct()
    query_blocks = asking.select("dim", "shard", "query_parts").distinct()
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["node", "weight", "vector", "home", "shards", "near"]
    searched = (
        data.join(graph, "node")
        .join(F.broadcast(query_blocks), ["dim", "shard"])
        .withColumn("query_part", every("query_parts"))
        .select(*order, F.lit(False).alias("query"), *columns)
    )
    asking = (
        asking.join(F.broadcast(blocks), ["dim", "shard"])
        .withColumn("part", every("parts"))
        .withColumn("shards", F.lit(None).cast("array<int>"))
        .withColumn("near", F.lit(None).cast("array<bigint>"))
        .select(*order, F.lit(True).alias("query"), *columns)
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in _by_key(batches, 4):
            query = _one(table, "query").to_numpy(zero_copy_only=False)
            data, asked = table.filter(pa.array(~query)), table.filter(pa.array(query))
            if not len(data) or not len(asked):
                continue
            nodes, weight = _one(data, "node").to_numpy(), _one(data, "weight").to_numpy()
            exact = _unit(_rows(_one(data, "vector")))
            x = exact.astype(np.float32)
            queries, names = _unit(_rows(_one(asked, "vector"))), _one(asked, "node").to_numpy()
            by_node = np.argsort(nodes)
            lists = _one(data, "near")
            flat, ends = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
            at = np.minimum(np.searchsorted(nodes[by_node], flat), len(nodes) - 1)
            here = nodes[by_node][at] == flat
            owner = np.repeat(np.arange(len(nodes)), ends)[here]
            place = np.arange(len(owner)) - np.searchsorted(owner, owner)
            adjacent = np.full((len(nodes), max(int(place.max(initial=0)) + 1, 1)), -1)
            adjacent[owner, place] = by_node[at[here]]
            own = np.minimum(np.searchsorted(nodes[by_node], names), len(nodes) - 1)
            own = np.where(nodes[by_node][own] == names, by_node[own], -1)
            found = list(range_search(x, adjacent, exact, queries, own, entry_points(x), threshold))
            checked = np.linspace(0, len(queries) - 1, min(AUDITED, len(queries))).astype(int)
            # the vector itself is always found and tells nothing
            wanted = sum(int(((exact @ queries[i] >= threshold) & (nodes != names[i])).sum()) for i in checked)
            met = sum(int((nodes[found[i][1]] != names[i]).sum()) for i in checked)
            if met < RECALL * wanted:
                found = [(i, np.flatnonzero(exact @ q >= threshold)) for i, q in enumerate(queries)]
            homes, gain = _one(asked, "home").to_numpy(), _one(asked, "weight").to_numpy()
            lists = _one(data, "shards")
            flat, starts = lists.flatten().to_numpy(), lists.offsets.to_numpy()
            owner = np.repeat(np.arange(len(nodes)), np.diff(starts))
            # rows that ask in a query's own shard, per such shard
            back = {int(h): np.bincount(owner[flat == h], minlength=len(nodes)) > 0 for h in np.unique(homes)}
            extra = np.zeros(len(nodes), np.int64)
            up: dict[int, int] = {}

            def root(i: int, up=up) -> int:
                while up.setdefault(i, i) != i:
                    up[i] = up[up[i]]
                    i = up[i]
                return i

            out: list[tuple] = []
            for i, rows in found:
                name = int(names[i])
                rows = rows[nodes[rows] != name]
                extra[rows[~back[int(homes[i])][rows]]] += gain[i]
                out.append((name, None, int(weight[rows].sum())))
                for other in nodes[rows].tolist():
                    a, b = root(name), root(other)
                    if a != b:
                        up[max(a, b)] = min(a, b)
                        out.append((name, other, None))
            out += [(int(nodes[i]), None, int(extra[i])) for i in np.flatnonzero(extra)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), pa.int64()) for c in zip(*out, strict=True)], ["u", "v", "n"]
            )

    dealt = searched.union(asking).repartition(partitions(placed), *order).sortWithinPartitions(*order)
    return stage(dealt.mapInArrow(search, "u long, v long, n long"), "vector-links")


def _recall(nodes: DataFrame, counts: DataFrame, threshold: float) -> float:
    """Links counted of all links of the nodes whose id is divisible by 100, by brute force.

    The queries meet all nodes block by block; only counts per query leave a task.
    """
    parts = max(1, -(-nodes.count() // BLOCK))
    columns = ["node", "weight", "vector"]
    audited = nodes.filter(F.col("first") % 100 == 0).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    data = nodes.withColumn("part", F.pmod(F.xxhash64("node"), F.lit(parts)).cast("int"))
    both = data.select("dim", "part", F.lit(False).alias("query"), *columns).union(
        audited.select("dim", "part", F.lit(True).alias("query"), *columns)
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in _by_key(batches, 2):
            query = _one(table, "query").to_numpy(zero_copy_only=False)
            names, weight = _one(table, "node").to_numpy(), _one(table, "weight").to_numpy()
            x = _unit(_rows(_one(table, "vector")))
            asked = np.flatnonzero(query)
            for some in np.array_split(asked, max(1, len(asked) // 512)):
                near = (x[some] @ x[~query].T >= threshold) & (names[some][:, None] != names[~query])
                yield pa.RecordBatch.from_arrays([pa.array(names[some]), pa.array(near @ weight[~query], pa.int64())], ["node", "n"])

    dealt = both.repartition(partitions(nodes), "dim", "part").sortWithinPartitions("dim", "part")
    true = dealt.mapInArrow(count, "node long, n long").groupBy("node").agg(F.sum("n").alias("all"))
    met = true.join(counts, "node", "left").agg(F.sum("n"), F.sum("all")).first()
    return 1.0 if not met[1] else (met[0] or 0) / met[1]


def near_duplicate_vectors(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", threshold: float = THRESHOLD
) -> DataFrame:
    """Links and components of vectors whose cosine is ``threshold`` or more.

    Equal vectors are one node with a weight.  Nodes go to the shard of the nearest centre, of those
    fitted on a bounded sample.  Blocks of a shard are built into robustly pruned graphs, and every
    node is a query in its shard and in those whose boundary is within a margin: greedy search from
    medoids, then on through all neighbours in range.  Hits are verified in double precision.  Each
    task audits some queries against its whole block and compares all of them if too few links were
    found.  Then the links of the nodes whose id is divisible by 100 are counted by brute force; if
    less than ``RECALL`` of them were found, the search is done again with the next margin, the last
    of which leaves no pair without a shard to meet in.  That audit compares n * n / 100 pairs.
    Shards of any size are cut into blocks, and each block of queries meets each block of the
    shard, so a task holds two blocks.  Links leave a task as counts per vector and as links that
    connect something new, so groups of copies or near-copies are never written out as pairs.

    Returns ``id_column, n_links, component_id, kept``, one row per input row.  Null and zero
    vectors and those with null or non-finite components are linked with nothing, as are vectors of
    different lengths; a null id is linked with nothing, has a null component and is kept.  Rows
    with a repeated id count as vectors of their own that share a component.  An empty table gives
    no rows; other columns are left out, whatever their names.
    """
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector")
    )
    usable = rows.filter(F.col("id").isNotNull() & _usable("vector"))
    nodes = stage(
        usable.groupBy("vector").agg(F.min("id").alias("node"), F.count("id").alias("weight")).withColumn("dim", F.size("vector")),
        "vector-nodes",
    )
    # an id with several vectors names several nodes; each gets a name of its own
    nodes = stage(
        nodes.withColumn("first", F.col("node")).withColumn("node", F.monotonically_increasing_id()), "vector-names"
    )
    centres = _centres(nodes)
    graph = None
    for deviations in MARGINS:
        placed = _shards(nodes, centres, deviations, threshold)
        graph = _graph(placed) if graph is None else graph  # blocks do not depend on the margin
        found = _found(placed, graph, threshold)
        counts = found.filter("n is not null").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("n"))
        if _recall(nodes, counts, threshold) >= RECALL:
            break
    named = usable.join(nodes.select("vector", "node", "first", "weight"), "vector").select("id", "node", "first", "weight")
    named = stage(named, "vector-members")
    firsts = nodes.select("node", "first")
    ends = found.filter("v is not null").select("u", "v")
    links = (
        ends.join(firsts.withColumnsRenamed({"node": "u", "first": "a"}), "u")
        .join(firsts.withColumnsRenamed({"node": "v", "first": "b"}), "v")
        .select(F.col("a").alias("u"), F.col("b").alias("v"))
    )
    copies = named.filter("id != first").select(F.col("id").alias("u"), F.col("first").alias("v"))
    joined = components(links.union(copies), "vector-components").withColumnsRenamed({"node": "id"})
    direct = named.join(counts, "node", "left").select(
        "id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    )
    apart = rows.filter(F.col("id").isNull() | ~_usable("vector")).select("id", F.lit(0).cast("long").alias("n_links"))
    return direct.union(apart).join(joined, "id", "left").select(
        F.col("id").alias(id_column),
        "n_links",
        F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.coalesce("component", "id") == F.col("id"), F.lit(True)).alias("kept"),
    )


def audit_recall(
    vectors: DataFrame, found: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", threshold: float = THRESHOLD
) -> float:
    """Links found of all links of the vectors whose id is divisible by 100, by brute force.

    The queries meet all rows block by block; only counts per query leave a task.
    """
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector")
    ).filter(F.col("id").isNotNull() & _usable("vector"))
    rows = stage(rows.withColumn("dim", F.size("vector")), "audit-rows")
    parts = max(1, -(-rows.count() // BLOCK))
    queries = rows.filter("id % 100 = 0").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    data = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int"))
    both = data.select("dim", "part", F.lit(False).alias("query"), "id", "vector").union(
        queries.select("dim", "part", F.lit(True).alias("query"), "id", "vector")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in _by_key(batches, 2):
            query = _one(table, "query").to_numpy(zero_copy_only=False)
            x = _unit(_rows(_one(table, "vector")))
            n = [int((x[~query] @ q >= threshold).sum()) for q in x[query]]
            yield pa.RecordBatch.from_arrays([_one(table, "id").filter(pa.array(query)), pa.array(n, pa.int64())], ["id", "n"])

    dealt = both.repartition(partitions(rows), "dim", "part").sortWithinPartitions("dim", "part")
    true = dealt.mapInArrow(count, "id long, n long").groupBy("id").agg((F.sum("n") - 1).alias("n"))
    met = true.join(found.select(F.col(id_column).alias("id"), "n_links"), "id").agg(F.sum("n_links"), F.sum("n")).first()
    return 1.0 if not met[1] else met[0] / met[1]
