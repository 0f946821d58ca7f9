"""Near-duplicate vectors by a robust-pruned graph on overlapping shards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm.common import col, saved, ship
from rosterflow.llm.components import connected_components
from rosterflow.llm.flat_graph import build_graph, medoid, range_search

#: Rows of a shard that share one graph, and rows that search it in one task.
PART = 3000
#: What rounding may add to the products of unit vectors that tell how far a border is.
ROUNDING = 1e-7


def unit_vectors(vectors: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """(id, label, unit, hi, lo): the vector at length one as packed doubles and a digest of it; only vectors that can have links."""
    schema = pa.schema([("id", pa.int64()), ("label", pa.string()), ("unit", pa.binary()), ("hi", pa.int64()), ("lo", pa.int64())])

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, label, values in zip(*(c.to_pylist() for c in batch.columns)):
                if i is None or label is None or not values or None in values:
                    continue
                v = np.array(values, dtype=float)
                top = np.abs(v).max()
                if not np.isfinite(v).all() or top == 0:
                    continue
                v = v / top
                unit = (v / np.sqrt(v @ v)).tobytes()
                digest = xxhash.xxh3_128_digest(unit)
                hi, lo = (int.from_bytes(digest[k : k + 8], "little", signed=True) for k in (0, 8))
                rows.append((i, label, unit, hi, lo))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    ship(vectors.sparkSession)
    picked = vectors.select(col(id_column).cast("long").alias("id"), col(label_column).cast("string").alias("label"), col(vector_column).cast("array<double>").alias("v"))
    return picked.mapInArrow(scale, "id long, label string, unit binary, hi long, lo long")


def centres(sample: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Unit centres of ``k`` clusters of a sample of unit vectors, by spherical k-means from spread rows."""
    random = np.random.default_rng(11)
    centre = sample[random.permutation(len(sample))[:k]]
    for _ in range(rounds):
        of = (sample @ centre.T).argmax(axis=1)
        total = np.zeros_like(centre)
        np.add.at(total, of, sample)
        size = np.sqrt((total**2).sum(axis=1, keepdims=True))
        centre = np.where(size > 1e-12, total / np.maximum(size, 1e-12), centre)
    return centre


def shard_members(classes: DataFrame, centre: np.ndarray, reach: float) -> DataFrame:
    """(label, cluster, homed, id, copies, unit, shards) of each class for every cluster that it is in or near.

    ``homed`` is the cluster it is in, and the row there names all of them as ``shards``.

    A class is near a cluster if it lies within ``reach`` of the plane halfway between that cluster's centre and its
    own. Vectors of another length than the centres' go to clusters of their own, by length.
    """
    schema = pa.schema(
        [
            ("label", pa.string()), ("cluster", pa.int64()), ("homed", pa.int64()), ("id", pa.int64()), ("copies", pa.int64()),
            ("unit", pa.binary()), ("shards", pa.list_(pa.int64())),
        ]
    )
    k, width = centre.shape
    between = np.sqrt(np.maximum(0.0, 2 - 2 * centre @ centre.T))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = batch.column(3).to_pylist()
            own = np.array([len(u) == 8 * width for u in units])
            rows, clusters, homed, shards = [], [], [], []
            if own.any():
                at = np.flatnonzero(own)
                v = np.frombuffer(b"".join(units[i] for i in at.tolist())).reshape(-1, width)
                score = v @ centre.T
                best = score.argmax(axis=1)
                gap = score[np.arange(len(v)), best][:, None] - score
                row, cluster = np.nonzero((gap <= reach * between[best] + ROUNDING) | (np.arange(k) == best[:, None]))
                rows, clusters, homed = at[row], cluster, best[row]
                ends = np.searchsorted(row, np.arange(len(v) + 1))
                shards = [cluster[ends[r] : ends[r + 1]].tolist() if c == best[r] else None for r, c in zip(row, cluster)]
            other = np.flatnonzero(~own)
            rows = np.concatenate([rows, other]).astype(np.int64)
            lengths = [-len(units[i]) for i in other.tolist()]
            clusters = np.concatenate([clusters, lengths]).astype(np.int64)
            homed = np.concatenate([homed, lengths]).astype(np.int64)
            shards = pa.array(shards + [[x] for x in lengths], pa.list_(pa.int64()))
            taken = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [taken.column(0), pa.array(clusters), pa.array(homed), taken.column(1), taken.column(2), taken.column(3), shards], schema=schema
            )

    return classes.select("label", "id", "copies", "unit").mapInArrow(
        place, "label string, cluster long, homed long, id long, copies long, unit binary, shards array<long>"
    )


def adjacency(members: DataFrame) -> DataFrame:
    """(label, id, near): of each class its neighbours in the graphs of all parts it is in, together."""
    schema = pa.schema([("label", pa.string()), ("id", pa.int64()), ("near", pa.list_(pa.int64()))])

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        ids = group["id"].to_numpy()
        v = np.frombuffer(b"".join(group["unit"].to_pylist())).reshape(len(ids), -1)
        near = [ids[row].tolist() for row in build_graph(v)]
        return pa.table([group["label"], group["id"], pa.array(near, pa.list_(pa.int64()))], schema=schema)

    built = members.groupBy("label", "cluster", "part").applyInArrow(build, "label string, id long, near array<long>")
    return built.groupBy("label", "id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))


def searched(members: DataFrame, queries: DataFrame, least: float, audit_every: int) -> DataFrame:
    """(id, links, root, repaired) per query and part: how many vectors of the part are linked with the class, and the smallest
    id that links inside the task join it with.

    A class of the part that was found gets a row too if links join it with a smaller id, or if its own home shard lacks
    queries that are linked with it; those are counted there.

    One query in ``audit_every`` is also compared with the whole part. If the search has missed any link of theirs, the
    part is compared with all queries of the task.
    """
    schema = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("root", pa.int64()), ("repaired", pa.bool_())])

    def search(asking: pa.Table, part: pa.Table) -> pa.Table:
        if not asking.num_rows or not part.num_rows:
            return schema.empty_table()
        part = part.sort_by("id")
        ids, copies = part["id"].to_numpy(), part["copies"].to_numpy()
        v = np.frombuffer(b"".join(part["unit"].to_pylist())).reshape(len(ids), -1)
        graph = []
        for row in part["near"].to_pylist():
            row = np.array(row or [], dtype=np.int64)
            at = np.searchsorted(ids, row)
            at[at == len(ids)] = 0
            graph.append(at[ids[at] == row] if len(row) else row)
        asked = asking["asked_id"].to_numpy()
        q = np.frombuffer(b"".join(asking["asked_unit"].to_pylist())).reshape(len(asked), -1)
        start = medoid(v)
        found = [range_search(v, graph, start, x, least) for x in q]
        audit = np.arange(0, len(asked), audit_every)
        exact = (q[audit] @ v.T >= least).sum(axis=1)
        repaired = bool((exact != [len(found[i]) for i in audit]).any())
        if repaired:
            found = [np.flatnonzero(v @ x >= least) for x in q]
        root: dict[int, int] = {}

        def top(i: int) -> int:
            while (up := root.get(i, i)) != i:
                root[i] = root.get(up, up)
                i = up
            return i

        homed, cluster = part["homed"].to_numpy(), asking["asked_cluster"][0].as_py()
        links, back = [], np.zeros(len(ids), dtype=np.int64)
        for i, hits, shards, weight in zip(asked.tolist(), found, asking["asked_shards"].to_pylist(), asking["asked_copies"].to_pylist()):
            others = ids[hits]
            links.append(int(copies[hits][others != i].sum()))
            away = hits[(homed[hits] != cluster) & (others != i)]
            back[away[~np.isin(homed[away], shards)]] += weight
            a = top(i)
            for b in set(map(top, others.tolist())):
                low, high = min(a, b), max(a, b)
                root[high] = low
                a = low
        joined = np.isin(ids, np.fromiter(root, np.int64, len(root))) & ~np.isin(ids, asked)
        told = np.flatnonzero((back > 0) | joined)
        named = asked.tolist() + ids[told].tolist()
        roots = [top(i) for i in named]
        return pa.table(
            [
                pa.array(named, pa.int64()), pa.array(links + back[told].tolist(), pa.int64()), pa.array(roots, pa.int64()),
                pa.array([repaired] * len(asked) + [False] * len(told)),
            ],
            schema=schema,
        )

    # New names: both sides come from the same rows, which a join by group cannot tell apart.
    asking = queries.select([F.col(c).alias(f"asked_{c}") for c in ("label", "cluster", "part", "block")] + ["id", "unit", "copies", "shards"])
    asking = asking.withColumnsRenamed({c: f"asked_{c}" for c in ("id", "unit", "copies", "shards")})
    return (
        asking.groupBy("asked_label", "asked_cluster", "asked_part", "asked_block")
        .cogroup(members.groupBy("label", "cluster", "part", "block"))
        .applyInArrow(search, "id long, links long, root long, repaired boolean")
    )


def near_duplicate_vectors(
    vectors: DataFrame,
    least: float = 0.98,
    reach: float | None = None,
    shard_rows: int = 1000,
    most_sample: int = 8192,
    audit_every: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """One row per row of ``vectors``: its id, ``n_links``, ``component_id``, ``kept`` and ``repaired``.

    Vectors of equal labels are linked if their cosine, in double precision, is ``least`` or more. ``n_links`` counts the
    other vectors linked directly, ``component_id`` is the smallest id that links reach, and the vector with that id is
    the one to keep.

    Vectors of one direction make a class; copies stop there and are only counted. Clusters come from at most
    ``most_sample`` classes (and no more than 32 MB of them), about ``shard_rows`` classes of the largest label to a cluster. A class also
    enters shards of clusters whose border it is near, within ``reach``. That is half the distance of linked vectors unless given, so
    that of two linked classes one at least is in the home shard of the other, which then counts the link for both; a
    smaller one loses links. Each part of a shard gets a robust-pruned graph, the
    adjacency lists of a class are united, and each class searches the graphs of its home shard from their medoids,
    expanding over the range. A sample of searches is audited against all rows of the part, and
    a part with a miss is scanned (``repaired``). Every link counted has been verified by its cosine.
    Large shards are dealt out in parts and blocks, so that no task holds a hot group, and no pair leaves a task.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows without a label or an id, have
    no link; without an id the component is null and the row is kept. Vectors of different lengths are never linked.
    Ids should be unique: rows of a repeated id count one by one, and each gets the id's result. An empty table gives none.
    """
    reach = np.sqrt(max(0.0, 2 - 2 * least)) / 2 if reach is None else reach
    units = saved(unit_vectors(vectors, id_column, vector_column, label_column))
    classes = saved(
        units.groupBy("label", "hi", "lo").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.first("unit").alias("unit"))
    )
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    width = classes.groupBy(F.length("unit").alias("bytes")).count().orderBy(F.desc("count"), "bytes").select("bytes").first()
    width = width[0] // 8 if width else 1
    rows = min(most_sample, max(1, (32 << 20) // (8 * width)))
    sample = classes.filter(F.length("unit") == 8 * width).orderBy(F.xxhash64("id"), "id", "label").limit(rows).select("unit").collect()
    sample = np.frombuffer(b"".join(r[0] for r in sample)).reshape(len(sample), width)
    k = max(1, min(-(-largest // shard_rows), len(sample) // 8))
    centre = centres(sample, k) if len(sample) else np.zeros((1, width))
    members = saved(shard_members(classes, centre, float(reach)))

    shard = ["label", "cluster"]
    sizes = members.groupBy(*shard).agg(F.count("*").alias("n"), F.count_if(F.col("homed") == F.col("cluster")).alias("n_home"))
    sizes = sizes.select(*shard, F.ceil(F.col("n") / PART).alias("parts"), F.ceil(F.col("n_home") / PART).alias("blocks")).filter("blocks > 0")
    placed = members.join(sizes, shard).withColumn("part", F.pmod(F.xxhash64("id", F.lit(2)), "parts"))
    near = adjacency(placed)
    indexed = placed.join(near, ["label", "id"]).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    queries = placed.filter("homed = cluster").withColumn("block", F.pmod(F.xxhash64("id", F.lit(3)), "blocks"))
    queries = queries.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    asked = [*shard, "part", "block", "id", "unit", "copies"]
    hits = saved(searched(indexed.select(*asked, "homed", "near"), queries.select(*asked, "shards"), least, audit_every))
    labels = connected_components(hits.filter("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    labels = labels.withColumnRenamed("label", "reached")
    counted = hits.groupBy("id").agg(F.sum("links").alias("links"), F.max("repaired").alias("repaired"))
    of_class = classes.join(counted, "id", "left").join(labels, classes["id"] == labels["node"], "left")
    of_class = of_class.select(
        classes["label"],
        "hi",
        "lo",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
        F.coalesce("reached", classes["id"]).alias("component"),
        "repaired",
    )
    linked = units.join(of_class, ["label", "hi", "lo"]).groupBy("id").agg(
        F.max("links").alias("links"), F.min("component").alias("component"), F.max("repaired").alias("repaired")
    )
    own = vectors.select(col(id_column).cast("long").alias("own"))
    joined = own.join(linked, own["own"] == linked["id"], "left")
    component = F.coalesce("component", "own")
    return joined.select(
        F.col("own").alias(id_column),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("own").isNull() | (component == F.col("own"))).alias("kept"),
        F.coalesce("repaired", F.lit(False)).alias("repaired"),
    )
