"""Approximate nearest neighbours: an NN-descent graph and greedy search on it.

Building. Vectors are dealt to the nearest of at most ``MAX_PIVOTS`` sampled pivots, ``TABLES`` times with
other pivots; neighbours within a block start the graph (only the start depends on the sample; every
vector is in the graph). Then rounds of NN-descent, at least ``ROUNDS`` and until less than ``LEAST_FRESH`` of the
edges came in the last one: every node brings its neighbours and the nodes
it is a neighbour of together, those are compared with each other, and each keeps its ``DEGREE`` best. Only
pairs with a neighbour that came in the last round are compared, and only those that beat the worst
neighbour are sent on. Nodes that are neighbours of very many are split: their followers meet in chunks of
about ``CHUNK``, others in every round; none is left out.

Search. Each query starts at its own node and opens all unopened nodes of its beam, the ``BEAM`` best nodes
seen, at every hop, until all of the beam are open. The adjacency is stored as a bucketed table, so a hop moves
only the beam. Vectors keep all their digits and are compared in double precision throughout, so near copies are
told apart, however many there are. The beam is scored again on the original vectors.

Equal vectors form one node; their ids come back in order of the id.

Defined results: vectors that are NULL, empty, zero, or hold a NULL or non-finite component, NULL ids, and vectors
of another length than most take no part; of rows with the same id the smallest vector counts; ties go to the
smaller id; fewer candidates give fewer rows; other columns are not read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

TOP = 5
DEGREE = 24
TABLES, BLOCK, MAX_PIVOTS = 4, 800, 4096
ROUNDS = 3
LEAST_FRESH = 0.01
CHUNK = 2 * DEGREE
FLOATS, DOUBLES = b"f", b"d"
BEAM = 200


def _matrix(column: pa.Array) -> np.ndarray:
    """Unit vectors of codes, in double precision."""
    parts = column.to_pylist()
    if not parts:
        return np.empty((0, 0))
    floats = np.array([p[:1] == FLOATS for p in parts])
    rows = np.empty((len(parts), (len(parts[0]) - 1) // (4 if floats[0] else 8)))
    for kind, mask in ((np.float32, floats), (np.float64, ~floats)):
        if mask.any():
            rows[mask] = np.frombuffer(b"".join(p[1:] for p, m in zip(parts, mask) if m), kind).reshape(-1, rows.shape[1])
    return _unit(rows)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-30)


def _with_codes(batches):
    """All digits of the vectors, scaled by a power of two: as floats where these hold them, else as doubles."""
    for batch in batches:
        lists = batch.column("vector")
        if not batch.num_rows:
            continue
        rows = lists.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).astype(np.float64)
        rows = np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1))[1][:, None])
        short = rows.astype(np.float32)
        whole = (short == rows).all(axis=1)
        codes = [FLOATS + f.tobytes() if w else DOUBLES + d.tobytes() for f, d, w in zip(short, rows, whole)]
        yield pa.RecordBatch.from_arrays([batch.column("node"), lists, pa.array(codes, pa.binary())], ["node", "vector", "code"])


def usable(rows: DataFrame, id_col: str, vector: str) -> DataFrame:
    """``vec_id`` and ``vector`` (doubles) of the rows that take part, one per id."""
    plain = rows.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    plain = plain.filter("vec_id IS NOT NULL AND size(vector) > 0").filter(
        F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))) & F.exists("vector", lambda x: x != 0))
    plain = plain.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    sizes = plain.groupBy(F.size("vector").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.agg(F.max_by("length", F.struct("n", "length"))).scalar()
    return plain.filter(F.size("vector") == most)


def make_nodes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes: ``node``, ``vector``, ``code``; ids: ``node``, ``vec_id``). Equal vectors share a node."""
    vectors = common.stored(vectors, "ann-vectors")
    groups = common.stored(vectors.groupBy("vector").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("size")), "ann-groups")
    nodes = common.stored(groups.select("node", "vector").mapInArrow(_with_codes, "node long, vector array<double>, code binary"), "ann-nodes")
    twins = vectors.join(groups.filter("size > 1"), "vector").select("node", "vec_id")
    ids = groups.filter("size = 1").select("node", F.col("node").alias("vec_id")).unionByName(twins)
    return nodes, common.stored(ids, "ann-ids")


def _nearest_pivots(pivots: np.ndarray, owner: np.ndarray):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            near = _matrix(batch.column("code")) @ pivots.T
            for t in range(TABLES):
                block = np.where(owner == t, near, -9).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(block.astype(np.int32)), batch.column("node"), batch.column("code")],
                                                 ["block", "node", "code"])
    return run


def _block_neighbours(degree: int):
    def run(batches):
        for batch in batches:
            for members in batch.column("members"):
                node, code = members.values.flatten()
                ids = node.to_numpy(zero_copy_only=False)
                if len(ids) < 2:
                    continue
                rows, k = _matrix(code), min(degree, len(ids) - 1)
                for start in range(0, len(ids), 1024):
                    near = rows[start:start + 1024] @ rows.T
                    at = np.arange(len(near))
                    near[at, at + start] = -9
                    best = np.argpartition(-near, k - 1, axis=1)[:, :k]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(ids[start:start + 1024], k)), pa.array(ids[best].ravel()),
                         pa.array(np.take_along_axis(near, best, 1).ravel())], ["u", "v", "sim"])
    return run


def _local_join(batches):
    """Pairs within a list that include a fresh member and beat the first one's worst neighbour."""
    for batch in batches:
        us, vs, sims = [], [], []
        for members in batch.column("members"):
            x, worst, fresh, code = members.values.flatten()
            ids, first = np.unique(x.to_numpy(zero_copy_only=False), return_index=True)
            fresh_all = fresh.to_numpy(zero_copy_only=False)
            if len(ids) < 2 or not fresh_all.any():
                continue
            new = np.zeros(len(ids), bool)
            np.logical_or.at(new, np.searchsorted(ids, x.to_numpy(zero_copy_only=False)), fresh_all)
            rows = _matrix(code)[first]
            near = rows @ rows.T
            np.fill_diagonal(near, -9)
            a, b = np.nonzero((near > worst.to_numpy(zero_copy_only=False)[first][:, None]) & (new[:, None] | new[None, :]))
            us.append(ids[a])
            vs.append(ids[b])
            sims.append(near[a, b])
        if us:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs)),
                                              pa.array(np.concatenate(sims))], ["u", "v", "sim"])


def _best(edges: DataFrame, keys: str, degree: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(keys).orderBy(F.desc("sim"), "v"))
    return edges.withColumn("rank", rank).filter(F.col("rank") <= degree).drop("rank")


def start_graph(nodes: DataFrame, degree: int = DEGREE) -> DataFrame:
    """First neighbours (u, v, sim, fresh) from blocks around sampled pivots."""
    total = nodes.count()
    wanted = max(1, min(MAX_PIVOTS, -(-total // BLOCK)))
    sampled = nodes.select("node", "code").orderBy(F.xxhash64("node"), "node").limit(wanted * TABLES).collect()
    if not sampled:
        return nodes.sparkSession.createDataFrame([], "u long, v long, sim double, fresh boolean")
    pivots = _matrix(pa.array([bytes(r["code"]) for r in sampled], pa.binary()))
    owner = np.arange(len(sampled)) % TABLES if len(sampled) >= TABLES else np.zeros(len(sampled))
    dealt = nodes.select("node", "code").mapInArrow(_nearest_pivots(pivots, owner), "block int, node long, code binary")
    dealt = common.stored(dealt, "ann-blocks")
    sizes = dealt.groupBy("block").agg(F.count(F.lit(1)).alias("n"))  # at most MAX_PIVOTS * TABLES rows
    parts = F.ceil(F.col("n") / F.lit(2 * BLOCK))
    spread = dealt.join(F.broadcast(sizes), "block").withColumn("part", F.pmod(F.xxhash64("node"), parts))
    lists = spread.groupBy("block", "part").agg(F.collect_list(F.struct("node", "code")).alias("members"))
    found = lists.select("members").mapInArrow(_block_neighbours(degree), "u long, v long, sim double")
    found = found.repartition("u").groupBy("u", "v").agg(F.max("sim").alias("sim"))
    return common.stored(_best(found, "u", degree).withColumn("fresh", F.lit(True)), "ann-graph")


def descend(graph: DataFrame, nodes: DataFrame, degree: int = DEGREE, salt: int = 0) -> DataFrame:
    """One round: neighbours of neighbours are compared, every node keeps its best. ``salt`` deals the chunks."""
    worst = graph.groupBy("u").agg(F.min("sim").alias("low"), F.count(F.lit(1)).alias("n"))
    worst = worst.select(F.col("u").alias("x"), F.when(F.col("n") < degree, F.lit(-2.0)).otherwise(F.col("low")).alias("worst"))
    known = nodes.select(F.col("node").alias("x"), "code").join(worst, "x", "left").withColumn("worst", F.coalesce("worst", F.lit(-2.0)))
    chunks = graph.groupBy(F.col("v").alias("g")).agg(F.ceil(F.count(F.lit(1)) / F.lit(CHUNK)).alias("chunks"))
    ahead = graph.select(F.col("u").alias("g"), F.col("v").alias("x"), "fresh").join(chunks, "g", "left").select(
        "g", "x", "fresh", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("chunks", F.lit(1)) - 1)).alias("part"))
    back = graph.select(F.col("v").alias("g"), F.col("u").alias("x"), "fresh").join(chunks, "g").select(
        "g", "x", "fresh", F.pmod(F.xxhash64("x", F.lit(salt)), F.col("chunks")).alias("part"))
    members = ahead.unionByName(back).join(known, "x")
    lists = members.groupBy("g", "part").agg(F.collect_list(F.struct("x", "worst", "fresh", "code")).alias("members"))
    found = lists.select("members").mapInArrow(_local_join, "u long, v long, sim double").withColumn("fresh", F.lit(True))
    both = graph.withColumn("fresh", F.lit(False)).unionByName(found).repartition("u")
    merged = both.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    return common.stored(_best(merged, "u", degree), "ann-graph")


def build(nodes: DataFrame, rounds: int = ROUNDS, degree: int = DEGREE) -> DataFrame:
    graph, done = start_graph(nodes, degree), 0
    while done < rounds or (graph.agg(F.avg(F.col("fresh").cast("int"))).first()[0] or 0.0) >= LEAST_FRESH:
        graph, done = descend(graph, nodes, degree, done), done + 1
    return graph


def adjacency(graph: DataFrame, nodes: DataFrame) -> str:
    """Name of a table of neighbours in both directions with their vectors, bucketed by ``node``.

    A node has one row per about 2 * CHUNK neighbours. The files lie in the shared folder.
    """
    spark = graph.sparkSession
    links = graph.select(F.col("u").alias("node"), "v").unionByName(graph.select(F.col("v").alias("node"), F.col("u").alias("v"))).distinct()
    sizes = links.groupBy("node").agg(F.ceil(F.count(F.lit(1)) / F.lit(2 * CHUNK)).alias("chunks"))
    parts = links.join(sizes, "node").withColumn("part", F.pmod(F.xxhash64("v"), F.col("chunks")))
    filled = parts.join(nodes.select(F.col("node").alias("v"), "code"), "v")
    rows = filled.groupBy("node", "part").agg(F.collect_list(F.struct("v", "code")).alias("links")).drop("part")
    name = f"adjacency_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.write.bucketBy(buckets, "node").sortBy("node").option("path", common.scratch_path(spark, name)).saveAsTable(name)
    return name


def _open_nodes(batches):
    """Neighbours of opened nodes that beat the worst of the query's beam."""
    for whole in batches:
        for start in range(0, whole.num_rows, 2000):
            batch = whole.slice(start, 2000)
            lists = batch.column("links")
            v, code = lists.flatten().flatten()
            sizes = lists.value_lengths().to_numpy()
            if not len(v):
                continue
            at = np.repeat(np.arange(len(sizes)), sizes)
            queries, rows = _matrix(batch.column("query_code")), _matrix(code)
            sims = np.einsum("ij,ij->i", rows, queries[at])
            ids = batch.column("query").to_numpy()[at]
            good = sims > batch.column("worst").to_numpy()[at]
            yield pa.RecordBatch.from_arrays([pa.array(ids[good]), pa.array(v.to_numpy()[good]), pa.array(sims[good])], ["query", "v", "sim"])


def greedy_search(queries: DataFrame, links: DataFrame, nodes: DataFrame, beam: int = BEAM) -> DataFrame:
    """(``query``, ``v``, ``sim``): the beam of every query node when nothing in it is left to open."""
    codes = queries.select(F.col("node").alias("query")).distinct().join(
        nodes.select(F.col("node").alias("query"), F.col("code").alias("query_code")), "query")
    codes = common.stored(codes, "ann-queries")
    pool = codes.select("query", F.col("query").alias("v"), F.lit(1.0).alias("sim"), F.lit(False).alias("opened"))
    pool = common.stored(pool, "ann-beam")
    while True:
        closed = pool.filter("NOT opened")
        if closed.isEmpty():
            return pool.drop("opened")
        worst = pool.groupBy("query").agg(F.min("sim").alias("low"), F.count(F.lit(1)).alias("n")).select(
            "query", F.when(F.col("n") < beam, F.lit(-2.0)).otherwise(F.col("low")).alias("worst"))
        asked = closed.select("query", F.col("v").alias("node")).join(codes, "query").join(worst, "query")
        opened = asked.join(links, "node").select("query", "query_code", "worst", "links")
        seen = opened.mapInArrow(_open_nodes, "query long, v long, sim double").withColumn("opened", F.lit(False))
        both = pool.withColumn("opened", F.lit(True)).unionByName(seen).groupBy("query", "v").agg(F.max("sim").alias("sim"), F.max("opened").alias("opened"))
        pool = common.stored(_best(both, "query", beam), "ann-beam")


def _cosines(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) for c in ("query_vector", "vector"))
        # powers of two change no digit and keep squares in range
        a, b = (np.ldexp(m, -np.frexp(np.abs(m).max(axis=1))[1][:, None]) for m in (a, b))
        score = np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))
        yield pa.RecordBatch.from_arrays([batch.column("query"), batch.column("v"), pa.array(score)], ["query", "v", "score"])


def nearest(rows: DataFrame, is_query, top: int = TOP, id_col: str = "vec_id", vector: str = "embedding", rounds: int = ROUNDS,
            degree: int = DEGREE, beam: int = BEAM) -> DataFrame:
    """The ``top`` nearest rows found for each query id: ``query_id``, ``rank``, ``vec_id``, ``score``.

    ``is_query`` is a condition on the column ``vec_id``.
    """
    nodes, ids = make_nodes(usable(rows, id_col, vector))
    links = adjacency(build(nodes, rounds, degree), nodes)
    spark = rows.sparkSession
    asked = common.stored(ids.filter(is_query).select("node", F.col("vec_id").alias("query_id")), "ann-asked")
    found = greedy_search(asked, spark.table(links), nodes, beam)
    spark.sql(f"DROP TABLE {links}")  # the beams are written, so nothing reads it again
    vectors = nodes.select("node", "vector")
    pairs = (found.select("query", "v").join(vectors.select(F.col("node").alias("v"), "vector"), "v")
             .join(vectors.select(F.col("node").alias("query"), F.col("vector").alias("query_vector")), "query"))
    scored = pairs.select("query", "v", "query_vector", "vector").mapInArrow(_cosines, "query long, v long, score double")
    by_node = Window.partitionBy("node").orderBy("vec_id")
    few = common.stored(ids.withColumn("place", F.row_number().over(by_node)).filter(F.col("place") <= top + 1).drop("place"), "ann-few")
    told = scored.join(few.select(F.col("node").alias("v"), "vec_id"), "v")
    nearby = common.stored(told.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")))
                           .filter(F.col("place") <= top + 1).select(F.col("query").alias("node"), "vec_id", "score"), "ann-nearby")
    # each query leaves itself out of the candidates of its node
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (asked.join(nearby, "node").filter("vec_id != query_id").withColumn("rank", rank).filter(F.col("rank") <= top)
            .select("query_id", "rank", "vec_id", "score"))
