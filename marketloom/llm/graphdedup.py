"""Near-duplicate vectors through a robust-pruned flat graph.

Exact copies are one class. Classes go to the shards of the medoids that are nearly as near as the nearest one, so that
shards overlap: to some as nodes of their graphs, to more as queries. Each shard builds a graph: a node's candidates, near and random, are pruned robustly (a candidate is left
out if a chosen neighbour is much nearer to it than the node is). A node's adjacency lists from all its shards are united.
Then each shard is searched from its medoid: greedily to a query's surroundings, and on from there through everything
that is nearly in range. A link counts in the home shard of its target, so that each is counted once; every link is
verified in double precision, and a sample's links are audited against brute force, with a wider search if too many of
its vectors lack some. The last search is brute force itself.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, discard, local_components, tuned, written

THRESHOLD = 0.9
#: Classes of a shard, about; members of a graph and queries of a task, at most; vectors that medoids are fitted on;
#: medoids, at most; queries of the audit; recall to reach.
SHARD, GRAPH, ASKED, FITTED, MEDOIDS, AUDITED, RECALL = 2048, 12_288, 24_576, 20_000, 4096, 200, 0.995
#: Neighbours of a node; near and random candidates; how much nearer the chosen neighbour has to be.
DEGREE, NEAR, FAR, ALPHA = 24, 40, 16, 1.2
#: Similarity below that of the nearest medoid to which a class asks further shards, and to which it is a node of their
#: graphs; beam width; similarity below the threshold through which a search still goes on. All but the first are for an
#: audit that falls short; a beam of 0 stands for the exact search, every class asked of every shard.
EFFORTS = ((0.12, 0.03, 12, 0.05), (0.3, 0.1, 32, 0.15), (2.1, 0.3, 64, 0.4), (2.1, 0.0, 0, 0.0))
#: Links from which a class of the audit belongs to a large group; those and the others have to reach RECALL each.
LARGE = 100


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def medoids(sample: np.ndarray, k: int) -> np.ndarray:
    """k rows of sample, each the one nearest to the mean of its cluster."""
    rng = np.random.default_rng(11)
    centres = sample[rng.permutation(len(sample))[:k]]
    for _ in range(6):
        near = np.concatenate([(sample[i : i + 4096] @ centres.T).argmax(axis=1) for i in range(0, len(sample), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-12), centres)
    return sample[np.unique([int((sample @ c).argmax()) for c in centres])]


def build(x: np.ndarray) -> np.ndarray:
    """Neighbours of each row (places, -1 for none): robust pruning of near and random candidates."""
    n = len(x)
    if n == 1:
        return np.full((1, 1), -1)
    rng, x = np.random.default_rng(5), x.astype(np.float32)
    near, out = min(NEAR, n - 1), np.full((n, DEGREE), -1)
    for i in range(0, n, 256):
        own = np.arange(i, min(n, i + 256))
        s = x[own] @ x.T
        s[np.arange(len(own)), own] = -2
        pool = np.concatenate([np.argpartition(-s, near - 1, axis=1)[:, :near], rng.integers(0, n, (len(own), FAR))], axis=1)
        sim = np.take_along_axis(s, pool, axis=1)
        vectors = x[pool]
        between = 1 - np.matmul(vectors, vectors.transpose(0, 2, 1))  # half the squared distances
        row, far = np.arange(len(own)), 1 - sim
        left = pool != own[:, None]
        for r in range(DEGREE):
            best = np.where(left, far, np.inf).argmin(axis=1)
            some = left[row, best]
            if not some.any():
                break
            out[own[some], r] = pool[row, best][some]
            left &= ~(ALPHA**2 * between[row, best] <= far) & (pool != pool[row, best][:, None])
    return out


class Graph:
    """Undirected links of n nodes: all of them as one run of neighbours for each node, and for the greedy walk rows of
    at most 2 * DEGREE, of a hub's many links some."""

    def __init__(self, pairs: np.ndarray, n: int):
        pairs = np.unique(np.concatenate([pairs, pairs[:, ::-1]]), axis=0)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        self.count = np.bincount(pairs[:, 0], minlength=n)
        self.first, self.to = np.cumsum(self.count) - self.count, pairs[:, 1]
        order = np.lexsort((np.random.default_rng(3).random(len(pairs)), pairs[:, 0]))
        place = np.arange(len(pairs)) - np.repeat(self.first, self.count)
        width = min(2 * DEGREE, max(1, int(self.count.max(initial=0))))
        few = place < width
        self.rows = np.full((n, width), -1)
        self.rows[pairs[order, 0][few], place[few]] = pairs[order, 1][few]

    def neighbours(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in nodes, and the neighbours there, one entry for each link."""
        count = self.count[nodes]
        of = np.repeat(np.arange(len(nodes)), count)
        return of, self.to[np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self.first[nodes], count)]


def range_search(x: np.ndarray, graph: Graph, start: int, queries: np.ndarray, own: np.ndarray, beam: int, low: float):
    """Yields (places of queries, places of rows) with a similarity of low or more that the search reaches. own: the rows
    that the queries are themselves, where there is no way to walk, -1 for queries that are none."""
    x32, step = x.astype(np.float32), 256
    links, n = graph.rows, len(x)
    beam = min(beam, n)
    for i in range(0, len(queries), step):
        q = queries[i : i + step].astype(np.float32)
        m = len(q)
        row = np.arange(m)
        seen = np.zeros((m, n), bool)
        ids = np.full((m, beam), -1)
        sim = np.full((m, beam), -2, np.float32)
        done = np.ones((m, beam), bool)
        at = own[i : i + step]
        ids[:, 0] = first = np.where(at < 0, start, at)
        sim[:, 0], done[:, 0], seen[row, first] = np.einsum("ij,ij->i", q, x32[first]), at >= 0, True
        for _ in range(8 * beam):
            best = np.where(done, -3, sim).argmax(axis=1)
            live = np.flatnonzero(~done[row, best])
            if not len(live):
                break
            done[live, best[live]] = True
            new = links[ids[live, best[live]]]
            fresh = (new >= 0) & ~seen[live[:, None], new]
            a, b = np.nonzero(fresh)
            seen[live[a], new[a, b]] = True
            s = np.full(new.shape, -2, np.float32)
            s[a, b] = np.einsum("ij,ij->i", q[live[a]], x32[new[a, b]])
            all_ids, all_sim = np.concatenate([ids[live], new], axis=1), np.concatenate([sim[live], s], axis=1)
            all_done = np.concatenate([done[live], ~fresh], axis=1)
            keep = np.argpartition(-all_sim, beam - 1, axis=1)[:, :beam]
            ids[live], sim[live], done[live] = (np.take_along_axis(z, keep, axis=1) for z in (all_ids, all_sim, all_done))
        # Everything within range of the query, through neighbours that are nearly so.
        a, b = np.nonzero((sim >= low) & (ids >= 0))
        b = ids[a, b]
        seen[:] = False
        seen[a, b] = True
        while len(a):
            yield a + i, b
            found = []
            for j in range(0, len(a), 20_000):
                of, nb = graph.neighbours(b[j : j + 20_000])
                flat = a[j : j + 20_000][of] * n + nb
                flat = np.unique(flat[~seen.ravel()[flat]])
                seen.ravel()[flat] = True
                f, g = np.divmod(flat, n)
                near = np.concatenate([np.einsum("ij,ij->i", q[f[t : t + 200_000]], x32[g[t : t + 200_000]]) for t in range(0, len(f), 200_000)] or [np.empty(0)]) >= low
                found.append((f[near], g[near]))
            a, b = (np.concatenate(z) for z in zip(*found))


def block_search(x: np.ndarray, queries: np.ndarray, low: float):
    """All (places of queries, places of rows) with a similarity of low or more."""
    for i in range(0, len(queries), 256):
        a, b = np.nonzero(queries[i : i + 256] @ x.T >= low)
        yield a + i, b


def _vectors(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return unit(flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1))


def _searched(classes: DataFrame, threshold: float, margin: float, inner: float, beam: int, slack: float) -> DataFrame:
    """Rows (a, links, b): links of class a to copies of other classes, or an edge a - b if b is not null."""
    n = classes.count()
    share = min(1.0, FITTED / max(1, n))
    fitted = classes.where(F.pmod(F.xxhash64("x", F.lit(3)), F.lit(1 << 30)) < int(share * (1 << 30))).select("x").limit(2 * FITTED).toPandas()
    sizes = {len(v) for v in fitted["x"]}
    chosen = {d: medoids(unit(np.stack([v for v in fitted["x"] if len(v) == d])), min(MEDOIDS, math.ceil(n / SHARD))) for d in sorted(sizes)}
    first, at = {}, 0
    for d, c in chosen.items():
        first[d], at = at, at + len(c)

    def dealt(batches):
        for b in batches:
            for d in sorted({len(v) for v in b.column("x").to_pylist()}):
                own = np.array([len(v) == d for v in b.column("x").to_pylist()])
                part = b.filter(pa.array(own))
                sim = _vectors(part.column("x")) @ chosen[d].T if d in chosen else np.zeros((part.num_rows, 1))
                home = sim.argmax(axis=1)
                row, shard = np.nonzero(sim >= sim.max(axis=1, keepdims=True) - margin)
                base = first.get(d, -d)  # vectors of a length that the sample missed are a shard of their own
                yield pa.record_batch({"shard": pa.array((base + shard).astype(np.int32)), "home": pa.array(shard == home[row]), "node": pa.array(sim[row, shard] >= sim.max(axis=1)[row] - inner), "id": part.column("id").take(pa.array(row)), "n": part.column("n").take(pa.array(row)), "x": part.column("x").take(pa.array(row))})

    members = written(classes.mapInArrow(dealt, "shard int, home boolean, node boolean, id long, n long, x array<double>"))
    counts = members.groupBy("shard").agg(F.count("*").alias("members"), F.count_if("node").alias("nodes")).collect()  # a row for each medoid
    salts = {r["shard"]: math.ceil(r["nodes"] / GRAPH) for r in counts if r["nodes"] > GRAPH}
    asks = {r["shard"]: math.ceil(r["members"] / ASKED) for r in counts if r["members"] > ASKED}
    lookup = lambda m: F.coalesce(F.element_at(F.create_map(*[F.lit(v) for kv in m.items() for v in kv]), F.col("shard")), F.lit(1)) if m else F.lit(1)
    members = members.withColumn("salts", lookup(salts)).withColumn("chunks", lookup(asks))
    members = members.withColumn("salt", F.pmod(F.xxhash64("id", F.lit(1)), F.col("salts")).cast("int")).withColumn("chunk", F.pmod(F.xxhash64("id", F.lit(2)), F.col("chunks")).cast("int"))

    def built(group: pa.Table) -> pa.Table:
        ids = group.column("id").to_numpy()
        links = build(_vectors(group.column("x")))
        return pa.table({"id": pa.array(ids), "near": pa.array([ids[r[r >= 0]].tolist() for r in links], pa.list_(pa.int64()))})

    lists = members.where("node").groupBy("shard", "salt").applyInArrow(built, "id long, near array<long>")
    united = lists.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    asking = members.where("not node").withColumn("near", F.array().cast("array<long>"))
    known = written(members.where("node").join(united, "id").unionByName(asking))
    every = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    # In a shard of several graphs or several groups of queries, each graph meets each group of queries.
    cells = known.select("*", F.explode(every("salts")).alias("g")).select("*", F.explode(every("chunks")).alias("c")).where("(node and g = salt) or c = chunk")

    def searched(group: pa.Table) -> pa.Table:
        g = lambda c: group.column(c).to_numpy(zero_copy_only=False)
        ids, copies, home, x = g("id"), g("n"), g("home").astype(bool), _vectors(group.column("x"))
        inside, asked = np.flatnonzero((g("salt") == g("g")) & g("node").astype(bool)), np.flatnonzero(g("chunk") == g("c"))
        out = [np.empty(0, np.int64)] * 3
        if len(inside) and len(asked):
            order = np.argsort(ids[inside])
            inside = inside[order]
            sizes = np.array([len(v) for v in group.column("near").take(pa.array(inside)).to_pylist()])
            near = np.concatenate(group.column("near").take(pa.array(inside)).to_pylist() or [[]]).astype(np.int64)
            to = np.minimum(np.searchsorted(ids[inside], near), len(inside) - 1)
            of = np.repeat(np.arange(len(inside)), sizes)
            there = ids[inside][to] == near
            y = x[inside]
            start = int((y @ y.mean(axis=0)).argmax())
            pairs = np.stack([of[there], to[there]], axis=1)
            own = np.minimum(np.searchsorted(ids[inside], ids[asked]), len(inside) - 1)
            own = np.where(ids[inside][own] == ids[asked], own, -1)
            links = np.zeros(len(ids))
            forest = (np.empty(0, np.int64), np.empty(0, np.int64))
            reached = range_search(y, Graph(pairs, len(y)), start, x[asked], own, beam, threshold - slack) if beam else block_search(y, x[asked], threshold - 1e-9)
            for a, b in reached:
                for t in range(0, len(a), 200_000):
                    p, q = asked[a[t : t + 200_000]], inside[b[t : t + 200_000]]
                    ok = (ids[p] != ids[q]) & home[q]
                    p, q = p[ok], q[ok]
                    ok = np.einsum("ij,ij->i", x[p], x[q]) >= threshold
                    p, q = p[ok], q[ok]
                    np.add.at(links, p, copies[q])
                    nodes, heads = local_components(np.append(forest[0], ids[p]), np.append(forest[1], ids[q]))
                    forest = (nodes[nodes != heads], heads[nodes != heads])
            some = np.flatnonzero(links)
            out = [np.concatenate([ids[some], forest[0]]), np.concatenate([links[some].astype(np.int64), np.zeros(len(forest[0]), np.int64)]), np.concatenate([np.full(len(some), -1), forest[1]])]
            return pa.table({"a": out[0], "links": out[1], "b": out[2], "edge": np.append(np.zeros(len(some), bool), np.ones(len(forest[0]), bool))})
        return pa.table({"a": out[0], "links": out[1], "b": out[2], "edge": np.empty(0, bool)})

    found = written(cells.groupBy("shard", "g", "c").applyInArrow(searched, "a long, links long, b long, edge boolean"))
    discard(members, known)
    return found


def audit(classes: DataFrame, links: DataFrame, threshold: float) -> float:
    """Share of the classes of a sample of AUDITED, of those with a link, of which links holds all that brute force finds.

    Classes of large groups and of small ones are counted apart, and the lesser share is the result.
    """
    n = classes.count()
    picked = classes.where(F.pmod(F.xxhash64("x", F.lit(17)), F.lit(1 << 30)) < int(min(1.0, AUDITED / max(1, n)) * (1 << 30))).select("id", "x").limit(2 * AUDITED).toPandas()
    if not len(picked):
        return 1.0
    ids, sizes = picked["id"].to_numpy(), picked["x"].map(len).to_numpy()
    by_size = {d: unit(np.stack(picked["x"][sizes == d])) for d in set(sizes)}

    def run(batches):
        for b in batches:
            total, lengths = np.zeros(len(ids), np.int64), np.array([len(v) for v in b.column("x").to_pylist()])
            for d, q in by_size.items():
                part = b.filter(pa.array(lengths == d))
                if part.num_rows:
                    near = (_vectors(part.column("x")) @ q.T >= threshold) & (part.column("id").to_numpy()[:, None] != ids[sizes == d])
                    total[sizes == d] += part.column("n").to_numpy() @ near
            yield pa.record_batch({"id": pa.array(ids), "links": pa.array(total)})

    true = classes.mapInArrow(run, "id long, links long").groupBy("id").agg(F.sum("links").alias("all"))
    shares = true.join(links.select(F.col("a").alias("id"), "links"), "id", "left").where(F.col("all") > 0).groupBy(F.col("all") >= LARGE).agg(F.avg((F.coalesce("links", F.lit(0)) >= F.col("all")).cast("double"))).collect()
    return min((r[1] for r in shares), default=1.0)


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """A row for each row of vectors (vec_id, embedding): vec_id, n_links, component_id, kept, audited_recall.

    Null, empty and zero vectors and those with null or non-finite components link with nothing. Vectors are compared
    with those of their own length. Equal vectors link with each other; of rows that share a vec_id each counts. An empty
    table gives no rows; a null vec_id keeps its row and never names a component that has another member. audited_recall
    is the audit's share, RECALL at least: a search that falls short is widened, and the last one is exact.
    """
    tuned(vectors.sparkSession)
    x = F.col("embedding").cast("array<double>")
    fine = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(F.coalesce(fine, F.lit(False)), F.transform(x, lambda v: v + F.lit(0.0))).alias("x"))
    # Classes are told apart by the vectors themselves and numbered; rows find theirs by 128 bits of it.
    name = {"k1": F.xxhash64("x"), "k2": F.xxhash64(F.lit(7), "x")}
    grouped = rows.where("x is not null").groupBy("x").agg(F.min("vec_id").alias("low"), F.count("*").alias("n"))
    classes = written(grouped.select(F.monotonically_increasing_id().alias("id"), *[c.alias(k) for k, c in name.items()], "low", "n", "x"))
    for effort in EFFORTS:
        found = _searched(classes.select("id", "n", "x"), threshold, *effort)
        links = written(found.where("not edge").groupBy("a").agg(F.sum("links").alias("links")))
        recall = audit(classes, links, threshold) if effort[2] else 1.0  # without a beam the search is exact
        if recall >= RECALL:
            break
    joined = components(found.where("edge").select("a", "b"))
    named = classes.drop("x").join(joined.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    named = written(named.join(links.withColumnRenamed("a", "id"), "id", "left"))
    least = written(named.groupBy("component").agg(F.min("low").alias("component_id")))
    known = written(named.join(least, "component").select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id"))
    out = rows.select("vec_id", *[F.when(F.col("x").isNotNull(), c).alias(k) for k, c in name.items()]).join(known, ["k1", "k2"], "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumns({"kept": F.col("vec_id").eqNullSafe(F.col("component_id")), "audited_recall": F.lit(float(recall))})
