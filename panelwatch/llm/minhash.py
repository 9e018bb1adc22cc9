"""Near-duplicate documents by one-permutation hashing.

1. A document's set of shingles is hashed once; the hash range is cut into ``BANDS * ROWS`` bins
   and each keeps its least hash. An empty bin takes the value of the first filled bin in a
   pseudo-random order of its own (optimal densification), the same in every document.
2. Equal sets are one node, so that thousands of copies are one row from here on.
3. Each band of bins names a bucket. The members of a bucket are joined to its first one only:
   as many candidate edges as members, however large the bucket.
4. Edges are confirmed on full sets, 100 * intersection >= percent * union, and components built.
5. A bucket whose members lie in several components may still hide a link between members that
   are not linked to its first one. In buckets of at most ``DIRECT`` members these pairs are
   confirmed one by one. Larger buckets are gathered in clusters (buckets that share members);
   the sets of a cluster are dealt into blocks of ``BLOCK_SHINGLES``, and each pair of blocks is
   compared in one task: members of different components that share a bucket. The largest
   component's blocks meet those of the others only, so that a group of near copies costs what
   its few stragglers cost. No candidate is left out, and none is a row of its own.

At similarity 0.8 a pair shares no bucket with a chance of about 3 in a million.

Cases: null and empty texts and texts without words have an empty set and are linked with
nothing; with fewer words than a shingle the whole sequence is one shingle; repeated rows and ids
are one node if their sets are equal, and the component is named by the smallest id that isn't
null; rows that share the smallest id of a group are all kept; columns named like the new ones
are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwatch.llm.common import append_arrow, arrow_type, hashes_of, map_arrow, mixed, run_hashes, sliced, stored
from panelwatch.llm.components import components

WORDS, PERCENT = 5, 80
BANDS, ROWS = 32, 5
BINS = BANDS * ROWS
TRIES = 1 << 10
DIRECT, BLOCK_SHINGLES = 32, 1 << 19


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text; A-Z count as a-z."""
    hashes = hashes_of(text.encode().lower().split())
    return np.unique(run_hashes(hashes, min(words, len(hashes)) or 1))


@cache
def _orders() -> np.ndarray:
    """For each bin, the bins to look into when it is empty."""
    at = np.arange(BINS * TRIES, dtype="u8")
    return (mixed(at, 3) % np.uint64(BINS)).astype("i4").reshape(BINS, TRIES)


def signature(found: np.ndarray) -> np.ndarray:
    """One hash for each bin, of a sorted set of hashes that isn't empty."""
    bins = ((found >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype("i4")
    filled, first = np.unique(bins, return_index=True)
    out = np.zeros(BINS, "u8")
    out[filled] = found[first]
    is_filled = np.zeros(BINS, bool)
    is_filled[filled] = True
    empty, orders = np.flatnonzero(~is_filled), _orders()
    source = np.full(BINS, -1)
    for attempt in range(TRIES):
        if not len(empty):
            break
        looked = orders[empty, attempt]
        hit = is_filled[looked]
        source[empty[hit]] = looked[hit]
        empty = empty[~hit]
    source[empty] = filled[0]
    taken = source >= 0
    out[taken] = out[source[taken]]
    return out


def buckets(values: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of a signature."""
    table = values.reshape(BANDS, ROWS)
    with np.errstate(over="ignore"):
        key = np.arange(BANDS, dtype="u8")
        for column in range(ROWS):
            key = mixed(key ^ table[:, column], column + 1)
    return key.view("i8")


def signed(df: DataFrame, words: int, text: str = "text") -> DataFrame:
    """``df`` with n_shingles, node (a 128-bit hash of the set, null if empty) and buckets."""

    def of(batch: pa.RecordBatch) -> list[pa.Array]:
        sizes, nodes, keys = [], [], []
        for value in batch.column(text).to_pylist():
            found = shingles(value or "", words)
            sizes.append(len(found))
            nodes.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
            keys.append(buckets(signature(found)) if len(found) else None)
        return [pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]

    return append_arrow(df, of, "n_shingles bigint, node binary, buckets array<bigint>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) of nodes whose full sets are alike enough."""
    u, v = (sets.select(F.col("node").alias(x), F.col("shingles").alias(f"set_{x}")) for x in "uv")
    both = pairs.join(u, "u").join(v, "v").select("u", "v", "set_u", "set_v")
    types = arrow_type("u binary, v binary")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            kept = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                a, b = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
                shared = len(np.intersect1d(a, b, assume_unique=True))
                kept.append(100 * shared >= percent * (len(a) + len(b) - shared))
            linked = batch.filter(pa.array(kept, pa.bool_()))
            yield pa.RecordBatch.from_arrays(
                [linked.column(i).cast(types.field(i).type) for i in (0, 1)], schema=types
            )

    return map_arrow(both, step, "u binary, v binary")


def _rerooted(found: DataFrame, links: DataFrame) -> DataFrame:
    """``found`` (node, root) after more links between nodes: components of roots only."""
    ends = links
    for end in "uv":
        of = found.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
        ends = ends.join(of, end, "left").withColumn(f"root_{end}", F.coalesce(f"root_{end}", end))
    roots = components(ends.select(F.col("root_u").alias("u"), F.col("root_v").alias("v")))
    moved = roots.select(F.col("node").alias("root"), F.col("root").alias("new"))
    old = found.join(moved, "root", "left").select("node", F.coalesce("new", "root").alias("root"))
    # Roots that had no links before are new nodes.
    return old.unionByName(roots.join(found.select("node"), "node", "left_anti").select("node", "root"))


def _compared_in_blocks(unsure: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) between members of large buckets (bucket, node, root, n_shingles, n)."""
    centre = unsure.groupBy("bucket").agg(F.min("node").alias("v"))
    clusters = components(unsure.join(centre, "bucket").select(F.col("node").alias("u"), "v"))
    nodes = unsure.groupBy("node", "root", "n_shingles").agg(F.collect_set("bucket").alias("buckets"))
    nodes = nodes.join(clusters.select("node", F.col("root").alias("cluster")), "node")
    parts = nodes.groupBy("cluster", "root").agg(F.sum("n_shingles").alias("size"))
    whole = parts.groupBy("cluster").agg(
        F.max_by("root", F.struct("size", "root")).alias("main"),
        F.max("size").alias("main_size"),
        F.sum("size").alias("size"),
    )
    blocks = whole.select(
        "cluster",
        "main",
        (1 + F.expr(f"main_size div {BLOCK_SHINGLES}")).alias("n_main"),
        (1 + F.expr(f"(size - main_size) div {BLOCK_SHINGLES}")).alias("n_rest"),
    )
    at = F.col("root") == F.col("main")
    count = F.when(at, F.col("n_main")).otherwise(F.col("n_rest"))
    dealt = nodes.join(blocks, "cluster").withColumn("own", F.pmod(F.xxhash64("node"), count)).withColumn("is_main", at)
    pair = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    upto = lambda n: F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)
    own = F.col("own")
    meets = F.when(F.col("is_main"), F.transform(upto("n_rest"), lambda i: pair("main", i, own))).otherwise(
        F.concat(
            F.transform(upto("n_main"), lambda j: pair("main", own, j)),
            F.transform(upto("n_rest"), lambda j: pair("rest", F.least(own, j), F.greatest(own, j))),
        )
    )
    rows = dealt.select("cluster", "node", "root", "n_shingles", "buckets", "own", "is_main", F.explode(meets).alias("pair"))
    rows = rows.select("cluster", "pair.*", "node", "root", "n_shingles", "buckets", "own", "is_main").join(sets, "node")
    types = arrow_type("u binary, v binary")

    def compare(table: pa.Table) -> pa.Table:
        kind, i, j = (table.column(c)[0].as_py() for c in ("kind", "i", "j"))
        found = table.sort_by("node").to_pylist()
        if kind == "main":
            left, right = [r for r in found if not r["is_main"]], [r for r in found if r["is_main"]]
        else:
            left, right = [r for r in found if r["own"] == i], [r for r in found if r["own"] == j]
        sets_of = {r["node"]: np.frombuffer(r["shingles"], "<u8") for r in found}
        holders: dict[int, list[int]] = {}
        for k, r in enumerate(right):
            for bucket in r["buckets"]:
                holders.setdefault(bucket, []).append(k)
        group = {r["root"]: r["root"] for r in found}

        def top(x: bytes) -> bytes:
            while group[x] != x:
                group[x] = x = group[group[x]]
            return x

        links = []
        for r in left:
            a = sets_of[r["node"]]
            for k in sorted({k for bucket in r["buckets"] for k in holders.get(bucket, ())}):
                q = right[k]
                b, low, high = sets_of[q["node"]], *sorted((r["n_shingles"], q["n_shingles"]))
                if 100 * low < percent * high or top(r["root"]) == top(q["root"]):
                    continue
                shared = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * shared >= percent * (len(a) + len(b) - shared):
                    group[top(r["root"])] = top(q["root"])
                    links.append((r["node"], q["node"]))
        return pa.Table.from_arrays([pa.array([x[c] for x in links], pa.binary()) for c in (0, 1)], schema=types)

    return rows.groupBy("cluster", "kind", "i", "j").applyInArrow(compare, "u binary, v binary")


def _with_sets(df: DataFrame, words: int) -> DataFrame:
    pack = lambda batch: [pa.array([shingles(x or "", words).astype("<u8").tobytes() for x in batch.column("text").to_pylist()], pa.binary())]
    return append_arrow(df, pack, "shingles binary").drop("text")


def near_duplicates(
    df: DataFrame, words: int = WORDS, percent: int = PERCENT, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept for each row of ``df``."""
    rows = df.select(
        F.col(key).cast("bigint").alias("doc_id"),
        F.col(text).alias("text"),
        F.xxhash64(text).alias("text_hash"),
    )
    known = stored(signed(rows, words).drop("text"), "signatures")
    # A node's first row names it and stands for its text.
    nodes = (
        known.where("node IS NOT NULL")
        .groupBy("node", "n_shingles")
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("row"), F.min("doc_id").alias("least_id"))
    )
    first = known.join(nodes.select("node", "row"), "node").where(
        F.col("doc_id").eqNullSafe(F.col("row.doc_id")) & (F.col("text_hash") == F.col("row.text_hash"))
    )
    spread = first.dropDuplicates(["node"]).select("node", "n_shingles", F.explode("buckets").alias("bucket"))
    centre = F.struct(F.xxhash64("node", "bucket").alias("o"), "node", "n_shingles")
    full = (
        spread.groupBy("bucket")
        .agg(F.min(centre).alias("centre"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )
    members = stored(spread.join(full, "bucket"), "buckets")
    alike = lambda a, b: 100 * F.least(a, b) >= percent * F.greatest(a, b)
    pairs = members.where(
        (F.col("node") != F.col("centre.node")) & alike(F.col("n_shingles"), F.col("centre.n_shingles"))
    ).select(F.col("centre.node").alias("u"), F.col("node").alias("v"))
    wanted = members.select("node").distinct().join(nodes, "node").select("node", "row.*")
    # A null id is an id here; of repeated rows one stands for the node.
    same = rows["doc_id"].eqNullSafe(wanted["doc_id"]) & (rows["text_hash"] == wanted["text_hash"])
    texts = rows.join(wanted, same).select("node", rows["text"]).dropDuplicates(["node"])
    sets = stored(_with_sets(texts, words).select("node", "shingles"), "sets")
    links = stored(_confirmed(pairs.distinct(), sets, percent), "links")
    found = stored(components(links), "components")
    root = F.coalesce("root", "node").alias("root")
    placed = members.join(found, "node", "left").select("bucket", "node", "n_shingles", "n", root)
    mixed_ = placed.groupBy("bucket").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b")
    unsure = stored(placed.join(mixed_.select("bucket"), "bucket"), "unsure")
    small = unsure.where(F.col("n") <= DIRECT)
    other = small.select("bucket", F.col("node").alias("v"), F.col("root").alias("root_v"), F.col("n_shingles").alias("n_v"))
    pairs = (
        small.join(other, "bucket")
        .where("node < v AND root <> root_v")
        .where(alike(F.col("n_shingles"), F.col("n_v")))
        .select(F.col("node").alias("u"), "v")
    )
    late = _confirmed(pairs.distinct(), sets, percent).unionByName(
        _compared_in_blocks(unsure.where(F.col("n") > DIRECT), sets, percent)
    )
    found = stored(_rerooted(found, stored(late, "links")), "components")
    names = (
        nodes.join(found, "node").groupBy("root").agg(F.min("least_id").alias("component_id"))
    )
    named = nodes.join(found, "node", "left").join(names, "root", "left")
    named = named.select("node", F.coalesce("component_id", "least_id").alias("component_id"))
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return (
        known.join(named, "node", "left")
        .withColumn("component_id", component)
        .select("doc_id", "text_hash", "n_shingles", "component_id")
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
