"""Approximate nearest neighbours: an NN-descent graph and greedy search in it.

Equal vectors are one node, named by their smallest id; each node keeps its smallest ids, enough to
answer any query. All distances are measured on the vectors as they are given (single precision if
the column has it, else double), in double precision; where two vectors are so close that the
product form would lose digits, their difference is taken. Of equal distances the order is that of a
hash of both nodes, so that nodes in a dense group do not all choose the same few.

Build. Start: random-hyperplane trees put rows in an order in which blocks of ``BLOCK`` rows are
compared in full. Then rounds of NN-descent: every node's neighbours, and a sample of the nodes that
have it as a neighbour, meet at that node by joins; of each pair with a new member the closest are
proposed to both sides, and each node keeps its ``DEGREE`` nearest. Hubs are cut to ``REVERSE``
members before the shuffle, so no group grows with the data.

Search. The beam of a query holds the nearest ``BEAM`` nodes seen. In each round its nodes that
were not expanded are joined with the adjacency rows, which carry the neighbours' vectors,
until no beam changes. It starts at the query's own node, if it has one, and at the nearest of
``PIVOTS`` nodes. The best ``RERANKED`` give the answer.

Defined cases: vectors that are null, zero, of another length than most, or hold null or non-finite
components take no part, nor do rows without an id; rows with equal id and vector count once.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tripmill.llm.common import batch_of, map_batches, released, staged

DEGREE = 20
REVERSE = 20
PROPOSED = 4
ROUNDS = 5
TREES = 4
BLOCK = 256
BEAM = 160
PIVOTS = 128
STARTS = 8
RERANKED = 60
SEARCH_ROUNDS = 24
CLOSE = 1e-8


def group_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of batches sorted by their first column, one table for each of its values."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column(0).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(np.diff(key)) + 1
        if held and held[-1].column(0)[0].as_py() != key[0]:
            yield pa.Table.from_batches(held)
            held = []
        start = 0
        for cut in cuts.tolist():
            yield pa.Table.from_batches([*held, batch.slice(start, cut - start)])
            held, start = [], cut
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def _matrix(values: list[bytes], kind: str) -> np.ndarray:
    """Rows of equal sizes, as a matrix of doubles."""
    return np.frombuffer(b"".join(values), kind).reshape(len(values), -1).astype(np.float64)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the rows; those below ``CLOSE`` of the norms come from differences."""
    centre = b.mean(axis=0)
    a, b = a - centre, b - centre
    norms = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :]
    d = np.maximum(norms - 2 * (a @ b.T), 0)
    left, right = np.nonzero(d <= CLOSE * norms)
    d[left, right] = ((a[left] - b[right]) ** 2).sum(1)
    return d


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two node numbers, for the order of equal distances."""
    x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ b.astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def kind_of(rows: DataFrame, vector: str) -> str:
    """How components are kept: single precision where the column has no more."""
    return "<f4" if isinstance(rows.schema[vector].dataType.elementType, T.FloatType) else "<f8"


def valid_vectors(rows: DataFrame, row_id: str, vector: str) -> DataFrame:
    """``id`` and ``raw`` (components of ``kind_of``) of the rows that take part."""
    kind = kind_of(rows, vector)
    rows = rows.select(F.col(row_id).cast("bigint").alias("id"),
                       F.col(vector).cast("array<double>").alias("v")).where("id is not null")
    common = (rows.where(F.size("v") > 0).groupBy(F.size("v").alias("n")).count()
              .orderBy(F.desc("count"), "n").first())
    size = common[0] if common else 0

    def check(batch: pa.RecordBatch) -> pa.RecordBatch:
        v = batch.column(1)
        right = np.array([n == size for n in v.value_lengths().to_pylist()], bool)
        rows = batch.filter(pa.array(right))
        flat = rows.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, max(size, 1))
        good = np.isfinite(flat).all(axis=1) & (flat != 0).any(axis=1)
        flat = (flat + 0.0).astype(kind)  # no negative zeros: equal vectors have equal bytes
        return batch_of(id=rows.column(0).filter(pa.array(good)),
                        raw=pa.array([r.tobytes() for r in flat[good]], pa.binary()))
    return map_batches(rows, check, "id bigint, raw binary").distinct()


def nodes_of(vectors: DataFrame, most: int) -> DataFrame:
    """Distinct vectors: ``node``, ``raw``, ``ids`` (the smallest ``most``)."""
    place = F.row_number().over(Window.partitionBy("raw").orderBy("id"))
    return (vectors.withColumn("place", place).where(F.col("place") <= most)
            .groupBy("raw").agg(F.array_sort(F.collect_list("id")).alias("ids"))
            .select(F.col("ids")[0].alias("node"), "raw", "ids"))


def _closest(node: np.ndarray, nbr: np.ndarray, dist: np.ndarray, degree: int,
             new: np.ndarray | None = None):
    """The nearest distinct neighbours of each node; of equal ones, the entry that is not new."""
    new = np.ones(len(node), bool) if new is None else new
    order = np.lexsort((new, nbr, node))
    node, nbr, dist, new = node[order], nbr[order], dist[order], new[order]
    once = (np.diff(node, prepend=-1) != 0) | (np.diff(nbr, prepend=-1) != 0)
    once |= np.arange(len(node)) == 0
    node, nbr, dist, new = node[once], nbr[once], dist[once], new[once]
    order = np.lexsort((_mixed(node, nbr), dist, node))
    node, nbr, dist, new = node[order], nbr[order], dist[order], new[order]
    first = np.flatnonzero(np.diff(node, prepend=node[0] - 1 if len(node) else 0) != 0)
    place = np.arange(len(node)) - np.repeat(first, np.diff(first, append=len(node)))
    keep = place < degree
    return node[keep], nbr[keep], dist[keep], new[keep]


def _edge_batch(node, nbr, dist, new) -> pa.RecordBatch:
    return batch_of(node=node.astype(np.int64), nbr=nbr.astype(np.int64),
                    dist=dist.astype(np.float64), new=new)


_EDGES = "node bigint, nbr bigint, dist double, new boolean"


def _kept(candidates: DataFrame, degree: int) -> DataFrame:
    """The ``degree`` nearest distinct neighbours of each node over all candidates."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held = [np.concatenate(x) for x in zip(held, now)] if held else now
            if not len(held[0]):
                continue
            cut = int(np.searchsorted(held[0], held[0][-1]))
            if cut:
                yield _edge_batch(*_closest(*(x[:cut] for x in held[:3]), degree, held[3][:cut]))
                held = [x[cut:] for x in held]
        if held and len(held[0]):
            yield _edge_batch(*_closest(*held[:3], degree, held[3]))
    return (candidates.repartition("node").sortWithinPartitions("node")
            .mapInArrow(released(run), _EDGES))


def _tree_edges(nodes: DataFrame, kind: str, tree: int, bits: int) -> DataFrame:
    """Near pairs inside blocks of rows that lie on the same sides of random hyperplanes."""
    def code(batch: pa.RecordBatch) -> pa.RecordBatch:
        v = _matrix(batch.column(1).to_pylist(), kind)
        planes = np.random.default_rng(tree).standard_normal((v.shape[1], bits + 1))
        side = (v @ planes[:, :bits] > 0) @ (1 << np.arange(bits, dtype=np.int64))
        return batch_of(code=side, along=v @ planes[:, bits], node=batch.column(0),
                        raw=batch.column(1))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                if part.num_rows < 2:
                    continue
                ids = part.column(2).to_numpy()
                v = _matrix(part.column(3).to_pylist(), kind)
                d = _squared(v, v)
                np.fill_diagonal(d, np.inf)
                n = min(DEGREE // 2, len(ids) - 1)
                best = np.argpartition(d, n - 1, axis=1)[:, :n]
                rows = np.repeat(np.arange(len(ids)), n)
                yield _edge_batch(ids[rows], ids[best.ravel()], d[rows, best.ravel()],
                                  np.ones(len(rows), bool))

    coded = map_batches(nodes.select("node", "raw"), code,
                        "code bigint, along double, node bigint, raw binary")
    return (coded.repartitionByRange("code", "along", "node")
            .sortWithinPartitions("code", "along", "node").mapInArrow(released(compare), _EDGES))


def _proposals(edges: DataFrame, nodes: DataFrame, kind: str, turn: int) -> DataFrame:
    """Pairs of neighbours of a common node that are close to each other."""
    worst = edges.groupBy("node").agg(F.max("dist").alias("worst"))
    full = nodes.select("node", "raw").join(worst, "node", "left")
    forward = edges.select(F.col("node").alias("centre"), F.col("nbr").alias("member"), "new")
    backward = edges.select(F.col("nbr").alias("centre"), F.col("node").alias("member"), "new")
    order = [F.desc("new"), F.xxhash64("centre", "member", F.lit(turn))]
    backward = (backward.withColumn("place", F.row_number().over(
        Window.partitionBy("centre").orderBy(*order))).where(F.col("place") <= REVERSE)
        .drop("place"))
    met = (forward.unionByName(backward).join(full, F.col("member") == F.col("node"))
           .select("centre", "member", "new", "raw", "worst"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list[np.ndarray]] = [[], [], []]
        size = 0

        def flush():
            found = [np.concatenate(x) for x in out]
            for x in out:
                x.clear()
            return _edge_batch(*_closest(*found, DEGREE))
        for group in group_runs(batches):
            ids = group.column(1).to_numpy()
            ids, own = np.unique(ids, return_index=True)
            if len(ids) < 2:
                continue
            group = group.take(pa.array(own))
            new = group.column(2).to_numpy(zero_copy_only=False).astype(bool)
            v = _matrix(group.column(3).to_pylist(), kind)
            worst = group.column(4).to_numpy()
            d = _squared(v, v)
            d[~(new[:, None] | new[None, :])] = np.inf
            np.fill_diagonal(d, np.inf)
            d[d >= worst[:, None]] = np.inf
            n = min(PROPOSED, len(ids) - 1)
            best = np.argpartition(d, n - 1, axis=1)[:, :n]
            rows = np.repeat(np.arange(len(ids)), n)
            near = d[rows, best.ravel()]
            good = np.isfinite(near)
            for column, x in zip(out, (ids[rows], ids[best.ravel()], near)):
                column.append(x[good])
            size += int(good.sum())
            if size > 1 << 19:
                yield flush()
                size = 0
        if size:
            yield flush()

    return met.repartition("centre").sortWithinPartitions("centre").mapInArrow(released(run), _EDGES)


def build_graph(nodes: DataFrame, kind: str, rounds: int = ROUNDS) -> DataFrame:
    """Edges ``node``, ``nbr``, ``dist`` (squared): the nearest found of each node."""
    bits = max(1, math.ceil(math.log2(max(2, nodes.count() / BLOCK))))
    start = _tree_edges(nodes, kind, 0, bits)
    for tree in range(1, TREES):
        start = start.unionByName(_tree_edges(nodes, kind, tree, bits))
    edges = staged(_kept(start, DEGREE), "graph")
    for turn in range(rounds):
        found = edges.withColumn("new", F.lit(False)).unionByName(_proposals(edges, nodes, kind, turn))
        edges = staged(_kept(found, DEGREE), "graph")
    return edges


def adjacency(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row a node: ``at``, ``nbrs``, and their vectors in the same order."""
    backward = edges.select(F.col("nbr").alias("node"), F.col("node").alias("nbr"), "dist")
    nearest = Window.partitionBy("node").orderBy("dist", F.xxhash64("node", "nbr"), "nbr")
    backward = (backward.withColumn("place", F.row_number().over(nearest))
                .where(F.col("place") <= REVERSE).drop("place"))
    both = edges.select("node", "nbr").unionByName(backward.select("node", "nbr")).distinct()
    full = nodes.select(F.col("node").alias("of"), "raw")
    return (both.join(full, F.col("nbr") == F.col("of"))
            .groupBy(F.col("node").alias("at"))
            .agg(F.collect_list(F.struct("nbr", "raw")).alias("near"))
            .select("at", F.col("near.nbr").alias("nbrs"), F.col("near.raw").alias("raws")))


def _by_query(rows: DataFrame, run: Callable, schema: str) -> DataFrame:
    return rows.repartition("query").sortWithinPartitions("query").mapInArrow(released(run), schema)


def search(queries: DataFrame, near: DataFrame, nodes: DataFrame, kind: str,
           beam: int = BEAM) -> DataFrame:
    """``query``, ``node``, ``dist`` (squared): the last beams.

    ``queries`` has ``query``, ``raw`` and ``start``, a node to begin at, or null.
    """
    spark = queries.sparkSession
    chosen = nodes.orderBy(F.xxhash64("node"), "node").limit(PIVOTS).select(
        "node", "raw").collect()
    pivots = spark.sparkContext.broadcast([tuple(r) for r in chosen])
    state_schema = ("query bigint, raw binary, seen array<bigint>, "
                    "beam array<bigint>, dists array<double>, todo array<bigint>")

    def begin(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = np.array([p[0] for p in pivots.value])
        d = _squared(_matrix(batch.column(1).to_pylist(), kind),
                     _matrix([bytes(p[1]) for p in pivots.value], kind))
        best = np.argsort(d, axis=1)[:, :STARTS]
        todo = [sorted({*ids[b].tolist(), *([s] if s is not None else [])})
                for b, s in zip(best, batch.column(2).to_pylist())]
        none = [[]] * batch.num_rows
        return batch_of(query=batch.column(0), raw=batch.column(1),
                        seen=pa.array(todo, pa.list_(pa.int64())),
                        beam=pa.array(none, pa.list_(pa.int64())),
                        dists=pa.array(none, pa.list_(pa.float64())),
                        todo=pa.array(todo, pa.list_(pa.int64())))

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        q = _matrix(batch.column(1).to_pylist(), kind)
        out = [_squared(q[i:i + 1], _matrix(raws, kind))[0]
               for i, raws in enumerate(batch.column(3).to_pylist())]
        return batch_of(query=batch.column(0), nbrs=batch.column(2),
                        dists=pa.array(out, pa.list_(pa.float64())))

    def advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in group_runs(batches):
            query = group.column(0)[0].as_py()
            rows = group.to_pylist()
            own = next(r for r in rows if r["raw"] is not None)
            ids = [np.array(own["beam"], np.int64)]
            dists = [np.array(own["dists"], np.float64)]
            for r in rows:
                if r["raw"] is None:
                    ids.append(np.array(r["beam"], np.int64))
                    dists.append(np.array(r["dists"], np.float64))
            ids, first = np.unique(np.concatenate(ids), return_index=True)
            dists = np.concatenate(dists)[first]
            best = np.lexsort((_mixed(np.full(len(ids), query), ids), dists))[:beam]
            ids, dists = ids[best], dists[best]
            todo = np.setdiff1d(ids, np.array(own["seen"], np.int64))
            yield pa.RecordBatch.from_pylist([{
                "query": query, "raw": own["raw"],
                "seen": own["seen"] + todo.tolist(), "beam": ids.tolist(),
                "dists": dists.tolist(), "todo": todo.tolist()}], schema=arrow_state)

    arrow_state = pa.schema([
        ("query", pa.int64()), ("raw", pa.binary()), ("seen", pa.list_(pa.int64())), ("beam", pa.list_(pa.int64())),
        ("dists", pa.list_(pa.float64())), ("todo", pa.list_(pa.int64()))])
    state = staged(map_batches(queries.select("query", "raw", "start"), begin,
                               state_schema), "beams")
    for _ in range(SEARCH_ROUNDS):
        if not state.agg(F.max(F.size("todo"))).first()[0]:
            break
        front = state.select("query", "raw", F.explode("todo").alias("node"))
        met = front.join(near, F.col("node") == F.col("at")).select(
            "query", front["raw"], "nbrs", "raws")
        found = map_batches(met, measure, "query bigint, nbrs array<bigint>, dists array<double>")
        none = F.lit(None)
        rows = state.unionByName(found.select(
            "query", none.cast("binary").alias("raw"),
            none.cast("array<bigint>").alias("seen"), F.col("nbrs").alias("beam"), "dists",
            none.cast("array<bigint>").alias("todo")))
        state = staged(_by_query(rows, advance, state_schema), "beams")
    return state.select("query", F.explode(F.arrays_zip("beam", "dists")).alias("x")).select(
        "query", F.col("x.beam").alias("node"), F.col("x.dists").alias("dist"))


def nearest(rows: DataFrame, is_query, k: int, row_id: str = "vec_id",
            vector: str = "embedding") -> DataFrame:
    """``query``, ``rank``, ``id`` and ``score`` (distance): the ``k`` nearest other rows found.

    Queries are rows of the indexed table, those for which ``is_query`` of their id holds.
    """
    kind = kind_of(rows, vector)
    vectors = staged(valid_vectors(rows, row_id, vector), "vectors")
    nodes = staged(nodes_of(vectors, k + 1), "nodes")
    near = staged(adjacency(build_graph(nodes, kind), nodes), "adjacency")
    asked = staged(vectors.where(is_query(F.col("id"))).join(
        nodes.select("node", F.col("raw").alias("own")),
        F.col("raw") == F.col("own")).select(
            F.col("id").alias("query"), F.col("node").alias("start"), "raw"),
        "queries")
    beams = search(asked, near, nodes, kind)
    place = F.row_number().over(Window.partitionBy("query").orderBy("dist", F.xxhash64("query", "node"), "node"))
    best = (beams.withColumn("place", place).where(F.col("place") <= max(RERANKED, k + 1))
            .select("query", "node")
            .unionByName(asked.select("query", F.col("start").alias("node"))).distinct())
    joined = (best.join(nodes.select("node", F.col("raw").alias("other"), "ids"), "node")
              .join(asked.select("query", "raw"), "query").select("query", "raw", "other", "ids"))

    def exact(batch: pa.RecordBatch) -> pa.RecordBatch:
        a, b = (_matrix(batch.column(i).to_pylist(), kind) for i in (1, 2))
        return batch_of(query=batch.column(0), ids=batch.column(3),
                        score=np.sqrt(((a - b) ** 2).sum(axis=1)))

    scored = map_batches(joined, exact, "query bigint, ids array<bigint>, score double")
    single = scored.select("query", F.explode("ids").alias("id"), "score").where("id != query")
    rank = F.row_number().over(Window.partitionBy("query").orderBy("score", "id"))
    return single.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query", "rank", "id", "score")
