"""Approximate nearest neighbours by cosine: probed lists and an adaptive scan of dimensions.

Vectors are scaled to length one and rotated at random, so that every block of ``BLOCK`` dimensions holds a fair part
of a distance. Each goes to the list of its nearest centre; a query probes the lists of its nearest centres. Within a
list the distance to a candidate is summed block by block, and after each block a hypothesis test compares it with the
query's fifth smallest distance so far: were the candidate as near, its partial distance would exceed the bound with
small probability only, and it is abandoned without reading the other dimensions.

Plan: equal vectors fold to one, with the few smallest ids that a result can need, so a very common vector costs as
much as any. Centres are fitted on a bounded sample, every vector is assigned. Lists are cut into parts of at most
``PART`` vectors and ``PART`` queries, so no group grows with the data; a task keeps the best of each query, which are
ranked once more over all parts. Scores are computed from the original numbers in double precision.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.text import sampled
from marquee.session import materialize

NEAREST = 5
EVERY = 50
BLOCK = 16
DOUBT = 2.1  # how far above its share, in units of 1/sqrt(dimensions), a partial distance may lie
SAMPLE = 20_000
ROUNDS = 12
MOST_LISTS = 65_536
PROBED_SHARE = 0.65  # of the lists; high, because the nearest of vectors with 64 unrelated dimensions lie in many lists
LEAST_PROBED = 16
PART = 4096
SEED = 11


def _usable(vector: Column) -> Column:
    """No null, no null or non-finite component, and not zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return vector.isNotNull() & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0)


def usable_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vec) of the rows that take part: usable vectors of the most frequent length, the smaller of equals."""
    good = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec")).filter(
        F.col("id").isNotNull() & _usable(F.col("vec"))
    )
    lengths = good.groupBy(F.size("vec").alias("n")).agg(F.count("*").alias("rows"))
    usual = lengths.agg(F.max_by("n", F.struct("rows", -F.col("n")))).first()[0]
    return good.filter(F.size("vec") == F.lit(usual or 0))


def folded(vectors: DataFrame, kept: int) -> DataFrame:
    """(vec_no, vec, ids): distinct vectors, numbered by their smallest id, with their ``kept`` smallest ids.

    The rank limit runs before the shuffle as well, so a vector with very many ids is a few rows per task.
    """
    in_order = Window.partitionBy("vec").orderBy("id")
    first = vectors.withColumn("n", F.row_number().over(in_order)).filter(F.col("n") <= kept)
    return first.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids")).select(
        F.get("ids", F.lit(0)).alias("vec_no"), "vec", "ids"
    )


@dataclass
class Index:
    centres: np.ndarray
    rotation: np.ndarray
    probed: int


def unit(vectors: np.ndarray) -> np.ndarray:
    largest = np.abs(vectors).max(1, keepdims=True)
    scaled = vectors / largest
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def fit_index(distinct: DataFrame, n: int, sample: int = SAMPLE, share: float = PROBED_SHARE) -> Index:
    """Centres by a few rounds of k-means on at most ``sample`` vectors (those with the smallest hash)."""
    rows = sampled(distinct.select("vec_no", "vec"), "vec_no", sample).collect()
    points = unit(np.array([row["vec"] for row in rows]))
    rng = np.random.default_rng(SEED)
    lists = int(min(MOST_LISTS, max(1, n ** 0.5), max(1, len(points) // 4)))
    centres = points[rng.choice(len(points), lists, replace=False)]
    for _ in range(ROUNDS):
        nearest = np.concatenate([np.argmax(part @ centres.T, 1) for part in np.array_split(points, len(points) // 4096 + 1)])
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-12), centres)
    rotation, _ = np.linalg.qr(rng.standard_normal((points.shape[1], points.shape[1])))
    return Index(centres, rotation, min(lists, max(LEAST_PROBED, round(lists * share))))


def assigned(distinct: DataFrame, index: Index) -> DataFrame:
    """Every distinct vector with the number of its list."""
    shared = distinct.sparkSession.sparkContext.broadcast(index.centres)

    def run(parts):
        for part in parts:
            if len(part):
                points = unit(np.stack(part["vec"].to_numpy()))
                yield part.assign(list_no=np.argmax(points @ shared.value.T, 1).astype(np.int32))

    return distinct.mapInPandas(run, "vec_no bigint, vec array<double>, ids array<bigint>, list_no int")


def probes(queries: DataFrame, index: Index, sizes: dict[int, int], wanted: int) -> DataFrame:
    """(query_no, vec, list_no): the nearest lists of each query, more of them while they hold fewer than
    ``wanted`` vectors. ``sizes`` has an entry per list."""
    context = queries.sparkSession.sparkContext
    held = np.array([sizes.get(i, 0) for i in range(len(index.centres))])
    shared = context.broadcast((index.centres, held, index.probed))

    def run(parts):
        centres, held, probed = shared.value
        for part in parts:
            if not len(part):
                continue
            order = np.argsort(-(unit(np.stack(part["vec"].to_numpy())) @ centres.T), 1, kind="stable")
            enough = np.argmax(np.cumsum(held[order], 1) >= min(wanted, held.sum()), 1) + 1
            count = np.maximum(probed, enough)
            at = np.repeat(np.arange(len(part)), count)
            lists = np.concatenate([order[i, :count[i]] for i in range(len(part))]).astype(np.int32)
            yield pd.DataFrame({"query_no": part["vec_no"].to_numpy()[at], "vec": part["vec"].to_numpy()[at], "list_no": lists})

    return queries.select("vec_no", "vec").mapInPandas(run, "query_no bigint, vec array<double>, list_no int")


def scan(queries: np.ndarray, points: np.ndarray, k: int, block: int = BLOCK, doubt: float = DOUBT):
    """For each query the k nearest of ``points`` as far as the tests let them through.

    Both are of length one and rotated. Yields (query numbers, point numbers, squared distances). Points are read in
    slices; the first slice is summed whole and gives each query its first bound.
    """
    n, dims = points.shape
    best = np.full((len(queries), k), np.inf)
    which = np.full((len(queries), k), -1)

    def take(q: np.ndarray, p: np.ndarray, d: np.ndarray) -> None:
        """Merge found distances into the best of their queries."""
        order = np.lexsort((p, d, q))
        q, p, d = q[order], p[order], d[order]
        firsts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
        rank = np.arange(len(q)) - np.repeat(firsts, np.diff(np.r_[firsts, len(q)]))
        near = rank < k
        q, p, d, rank = q[near], p[near], d[near], rank[near]
        rows = np.unique(q)
        wide_d, wide_p = np.full((len(queries), k), np.inf), np.full((len(queries), k), -1)
        wide_d[q, rank], wide_p[q, rank] = d, p
        both_d, both_p = np.hstack([best[rows], wide_d[rows]]), np.hstack([which[rows], wide_p[rows]])
        nearest = np.argsort(both_d, 1, kind="stable")[:, :k]
        best[rows], which[rows] = np.take_along_axis(both_d, nearest, 1), np.take_along_axis(both_p, nearest, 1)

    at, width = 0, 64
    while at < n:
        part = points[at:at + width]
        q, p = np.divmod(np.arange(len(queries) * len(part)), len(part))
        sums = np.zeros(len(q))
        for low in range(0, dims, block):
            high = min(low + block, dims)
            if len(q) == len(queries) * len(part):  # nobody abandoned yet: one matrix product
                a, b = queries[:, low:high], part[:, low:high]
                sums += ((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * a @ b.T).ravel()
            else:
                gap = queries[q, low:high] - part[p, low:high]
                sums += np.einsum("ij,ij->i", gap, gap)
            if high < dims:
                bound = best[q, -1] * (high / dims) * (1 + doubt / high ** 0.5) ** 2
                alive = sums <= bound
                if not alive.all():
                    q, p, sums = q[alive], p[alive], sums[alive]
        if len(q):
            take(q, p + at, np.maximum(sums, 0))
        at, width = at + width, 1024
    return best, which


def searched(lists: DataFrame, probed: DataFrame, index: Index, k: int, part: int = PART) -> DataFrame:
    """(query_no, vec_no, score): the best of each query within each part of the lists it probes."""
    sizes = lists.groupBy("list_no").agg(F.count("*").alias("vectors"))
    asked = probed.groupBy("list_no").agg(F.count("*").alias("queries"))
    shape = sizes.join(asked, "list_no").select(
        "list_no", F.ceil(F.col("vectors") / part).cast("int").alias("v_parts"), F.ceil(F.col("queries") / part).cast("int").alias("q_parts")
    )
    spread = lambda name, count: F.pmod(F.xxhash64(name), F.col(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    left = lists.join(shape, "list_no").select(
        "list_no", spread("vec_no", "v_parts").alias("v_part"), every("q_parts").alias("q_part"), "vec_no", "vec"
    )
    right = probed.join(shape, "list_no").select(
        "list_no", every("v_parts").alias("v_part"), spread("query_no", "q_parts").alias("q_part"), "query_no", "vec"
    )
    shared = lists.sparkSession.sparkContext.broadcast(index.rotation)

    def run(points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(points) or not len(queries):
            return pd.DataFrame({"query_no": [], "vec_no": [], "score": []})
        p, q = np.stack(points["vec"].to_numpy()), np.stack(queries["vec"].to_numpy())
        names, own = points["vec_no"].to_numpy(), queries["query_no"].to_numpy()
        found = []
        for low in range(0, len(q), 512):
            some = q[low:low + 512]
            _, which = scan(unit(some) @ shared.value, unit(p) @ shared.value, k)
            at, rank = np.nonzero(which >= 0)
            place = which[at, rank]
            found.append(pd.DataFrame({"query_no": own[low + at], "vec_no": names[place], "score": cosine(some[at], p[place])}))
        return pd.concat(found)

    keys = ["list_no", "v_part", "q_part"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(run, "query_no bigint, vec_no bigint, score double")


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of rows in double precision. Components beyond the range of squares are scaled first."""
    top, low = np.abs(a).max(1, keepdims=True), np.abs(b).max(1, keepdims=True)
    plain = (top < 1e150) & (top > 1e-150) & (low < 1e150) & (low > 1e-150)
    a, b = np.where(plain, a, a / top), np.where(plain, b, b / low)
    return (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))


def nearest(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", every: int = EVERY, k: int = NEAREST,
    share: float = PROBED_SHARE, part: int = PART,
) -> DataFrame:
    """(query_id, rank, key, score): for each row whose key is divisible by ``every`` the k nearest other rows found.

    The nearest have the largest cosine; equal ones go to the smaller key. Rows without a key, with a null or zero
    vector, with a null or non-finite component, or of an unusual length take no part, neither as query nor as
    candidate. Repeated keys are rows of their own: a query's other rows are those with another key. With fewer than
    k candidates all are returned; no rows give no rows. Other columns are ignored.
    """
    spark = rows.sparkSession
    schema = f"query_id bigint, rank int, {key} bigint, score double"
    usable = usable_vectors(rows, key, vector)
    distinct = materialize(folded(usable.dropDuplicates(["id", "vec"]), k + 1), "ann-vectors")
    n = distinct.count()
    if not n:
        return spark.createDataFrame([], schema)
    index = fit_index(distinct, n, share=share)
    lists = materialize(assigned(distinct, index), "ann-lists")
    sizes = {row["list_no"]: row["n"] for row in lists.groupBy("list_no").agg(F.count("*").alias("n")).collect()}
    asking = usable.filter(F.col("id") % every == 0).dropDuplicates(["id", "vec"])
    query_vectors = distinct.join(asking.select("vec").distinct(), "vec", "left_semi")
    probed = materialize(probes(query_vectors, index, sizes, 16 * (k + 1)), "ann-probes")
    found = searched(lists, probed, index, k + 1, part)
    order = Window.partitionBy("query_no").orderBy(F.desc("score"), "vec_no")
    best = found.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1).drop("n")
    # From vectors back to rows: the ids of the found vectors, and the queries that share the asking vector.
    named = best.join(lists.select("vec_no", "ids"), "vec_no").select("query_no", F.explode("ids").alias("id"), "score")
    first = Window.partitionBy("query_no").orderBy(F.desc("score"), "id")
    answers = (
        named.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k + 1).groupBy("query_no")
        .agg(F.array_sort(F.collect_list(F.struct("n", "id", "score"))).alias("answers"))
    )
    owners = asking.join(distinct.select("vec", F.col("vec_no").alias("query_no")), "vec").select(
        F.col("id").alias("query_id"), "query_no"
    )
    own = F.filter("answers", lambda a: a["id"] != F.col("query_id"))
    return owners.join(answers, "query_no").select("query_id", F.posexplode(F.slice(own, 1, k)).alias("p", "a")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("a.id").alias(key), F.col("a.score").alias("score")
    )
