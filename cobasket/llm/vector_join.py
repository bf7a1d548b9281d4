"""Near duplicates of vectors by an exact range join in a metric space.

Unit vectors at a cosine of at least ``threshold`` are those within ``radius`` of each other, so pivots and the
triangle inequality can tell far vectors apart without comparing them. Two kinds of places partition the vectors:

* A *core* is the ball of half the radius around a pivot. Its members are all linked with each other, whatever their
  number, so a core is counted and linked as a whole. A vector is linked with all members of another core, or with none,
  when its distance to the pivot and the core's own radius say so; only between the two does it meet the members.
* A *cell* holds the rest, by the nearest of some pivots. A vector is copied to another cell only if its ball of the
  radius reaches over the border between the two pivots, and over the ring of distances that the cell's members keep.

Two places meet in one of them, which each pair's numbers decide, so every pair is looked at once. A place joins by
itself: its members and the copies sent there are dealt out in blocks of bounded size, and each pair of blocks is a
group of its own, compared by matrix products. These run in single precision; what comes within its error of the
threshold is computed again in double precision.

Pivots are a bounded sample, chosen by the hash of the vector. They decide how much is compared, never what is found:
vectors without any structure, such as random directions in many dimensions, have no far cells at this radius, and
every cell then meets every other one.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from cobasket.llm.common import about, dropped, free, written
from cobasket.llm.components import connected_components

THRESHOLD = 0.9
CORES = 512  # pivots that cores are around, about
CELLS = 4096  # pivots of cells at most
CELL = 8192  # vectors that a cell is meant to have
LEFT, RIGHT = 8192, 32_768  # vectors of 64 dimensions in a block: members, and copies that they meet
TILE = 2048  # rows compared at a time
SLACK = 1e-6  # more than rounding can do to a distance


def usable(vector: Column) -> Column:
    """Neither null nor zero, without null, infinite or undefined components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(vectors: pa.Array, dim: int) -> np.ndarray:
    """Rows of length one, in double precision. Shorter vectors end in zeros."""
    lengths, flat = pc.list_value_length(vectors).to_numpy(), vectors.flatten().to_numpy().astype(float)
    if (lengths == dim).all():
        out = flat.reshape(-1, dim)
    else:
        out = np.zeros((len(vectors), dim))
        at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        out[np.repeat(np.arange(len(vectors)), lengths), at] = flat
    out = out / np.abs(out).max(axis=1, keepdims=True)  # squares can't overflow
    return out / np.sqrt((out * out).sum(axis=1, keepdims=True))


def distances(cosines: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * cosines))


class Places:
    """Cores 0, 1, ... and after them the cells: what is known of each, and where a vector belongs and is sent."""

    def __init__(self, core_pivots: np.ndarray, cell_pivots: np.ndarray, threshold: float):
        self.pivots = np.concatenate([core_pivots, cell_pivots])
        self.n_cores, self.n = len(core_pivots), len(core_pivots) + len(cell_pivots)
        self.radius = sqrt(2 - 2 * threshold)
        self.size = np.zeros(self.n, np.int64)
        self.near, self.far = np.full(self.n, np.inf), np.full(self.n, -np.inf)
        self.first = np.zeros(self.n, np.int64)
        apart = np.maximum(distances(cell_pivots @ cell_pivots.T), 1e-9)
        np.fill_diagonal(apart, 1.0)
        self.apart = apart

    def note(self, place: int, size: int, near: float, far: float, first: int) -> None:
        self.size[place], self.near[place], self.far[place], self.first[place] = size, near, far, first

    def home(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each vector and its distance to the pivot."""
        d = distances(vectors @ self.pivots.T)
        core, cell = d[:, :self.n_cores].argmin(axis=1), self.n_cores + d[:, self.n_cores:].argmin(axis=1)
        rows = np.arange(len(vectors))
        place = np.where(d[rows, core] <= self.radius / 2 - SLACK, core, cell)
        return place, d[rows, place]

    def meet(self, home: np.ndarray) -> np.ndarray:
        """For each vector and place: does the vector's home meet that place there? Cells meet cores at the core."""
        other = np.arange(self.n)
        lead = np.where((home[:, None] + other) % 2 == 0, np.minimum(home[:, None], other),
                        np.maximum(home[:, None], other))
        mixed = (home[:, None] >= self.n_cores) != (other >= self.n_cores)
        lead = np.where(mixed, np.minimum(home[:, None], other), lead)
        return (lead == other) & (home[:, None] != other) & (self.size > 0)

    def reach(self, vectors: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each vector and place that it meets there: linked with all of it, and linked with some of it perhaps."""
        cosines = vectors @ self.pivots.T
        d, meets = distances(cosines), self.meet(home)
        whole = meets & (d + self.far <= self.radius - SLACK)
        whole[:, self.n_cores:] = False
        some = meets & ~whole & (d - self.far <= self.radius + SLACK) & (self.near - d <= self.radius + SLACK)
        rim = np.flatnonzero(home >= self.n_cores)
        own = home[rim] - self.n_cores  # how far beyond the border the vector is, along the sphere
        sine = (cosines[rim, home[rim]][:, None] - cosines[rim, self.n_cores:]) / self.apart[own]
        beyond = 2 * np.sin(np.arcsin(np.clip(sine, 0.0, 1.0)) / 2)
        some[np.ix_(rim, np.arange(self.n_cores, self.n))] &= beyond <= self.radius + SLACK
        return whole, some


PLACED = "node long, copies long, v array<{}>, home int, distance double"
SENT = "kind int, place int, node long, n long, v array<{}>"
MEMBER, COPY, COUNT, LINK, GAIN = range(5)  # kinds of rows that placing gives
FOUND = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("other", pa.int64())])


def _slices(batches: Iterator[pa.RecordBatch], places: int) -> Iterator[pa.RecordBatch]:
    """Few rows at a time, as each has a number for every place."""
    step = max(16, (1 << 20) // max(1, places))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def placed(classes: DataFrame, places: Places, dim: int, kind: str) -> DataFrame:
    """Classes with their home and their distance to its pivot."""
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, places.n):
            home, d = places.home(unit(batch.column("v"), dim))
            yield pa.record_batch([*batch.columns, pa.array(home, pa.int32()), pa.array(d)],
                                  names=["node", "copies", "v", "home", "distance"])

    return classes.select("node", "copies", "v").mapInArrow(mapped, PLACED.format(kind))


def sent(rows: DataFrame, places: Places, dim: int, kind: str) -> DataFrame:
    """What placing gives, by kind: members of places and copies sent to other ones, with their vectors; how many links
    whole cores give a class; links between nodes; how many links a core's members gain from outside."""
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains, links = np.zeros(places.n, np.int64), set()
        names = ["kind", "place", "node", "n", "v"]
        for batch in _slices(batches, places.n):
            v, home = batch.column("v"), batch.column("home").to_numpy()
            node, copies = batch.column("node").to_numpy(), batch.column("copies").to_numpy()
            whole, some = places.reach(unit(v, dim), home)
            core = home < places.n_cores
            own = np.where(core, places.size[home], copies) - 1
            gains += (whole * copies[:, None]).sum(axis=0)
            who, where = np.nonzero(whole)
            ends = np.where(core, places.first[home], node)
            links.update(zip(ends[who].tolist(), places.first[where].tolist()))
            links.update(zip(node[core].tolist(), places.first[home[core]].tolist()))
            if len(links) > 1 << 16:
                yield _sent_batch(LINK, *zip(*links), v=v)
                links = set()
            yield _sent_batch(COUNT, node, own + (whole * places.size).sum(axis=1), place=home, v=v)
            yield pa.record_batch([pa.nulls(len(node), pa.int32()).fill_null(MEMBER), batch.column("home"),
                                   batch.column("node"), batch.column("copies"), v], names=names)
            who, where = np.nonzero(some)
            for at in range(0, len(who), 1 << 13):
                part = pa.array(who[at:at + (1 << 13)])
                yield pa.record_batch([pa.nulls(len(part), pa.int32()).fill_null(COPY),
                                       pa.array(where[at:at + (1 << 13)], pa.int32()), batch.column("node").take(part),
                                       batch.column("copies").take(part), v.take(part)], names=names)
        empty = pa.array([], pa.list_(pa.from_numpy_dtype(np.float32 if kind == "float" else np.float64)))
        if links:
            yield _sent_batch(LINK, *zip(*links), v=empty)
        at = np.flatnonzero(gains)
        if len(at):
            yield _sent_batch(GAIN, np.zeros(len(at), np.int64), gains[at], place=at, v=empty)

    return rows.mapInArrow(mapped, SENT.format(kind))


def _sent_batch(kind: int, node, n, v: pa.Array, place=None) -> pa.RecordBatch:
    size = len(node)
    return pa.record_batch([pa.array(np.full(size, kind, np.int32)),
                            pa.nulls(size, pa.int32()) if place is None else pa.array(place, pa.int32()),
                            pa.array(node, pa.int64()), pa.array(n, pa.int64()), pa.nulls(size, v.type)],
                           names=["kind", "place", "node", "n", "v"])


def spanning(hits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows and columns (numbered after the rows) that connect what the hits connect, few of them."""
    n, m = hits.shape
    if np.count_nonzero(hits) <= 2 * (n + m):
        rows, columns = np.nonzero(hits)
        return rows, n + columns
    of_column = np.arange(m, dtype=np.int32)
    while True:  # the smallest column that each reaches
        of_row = np.where(hits, of_column, np.int32(m)).min(axis=1)
        now = np.minimum(of_column, np.where(hits, of_row[:, None], np.int32(m)).min(axis=0))
        if (now == of_column).all():
            break
        of_column = now
    rows, columns = np.flatnonzero(of_row < m), np.flatnonzero(of_column < np.arange(m))
    return np.concatenate([rows, n + columns]), n + np.concatenate([of_row[rows], of_column[columns]])


def weighted(hits: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """For each row, the sum of ``copies`` where it hits."""
    if (copies == 1).all():
        return np.count_nonzero(hits, axis=1)
    rows, columns = np.nonzero(hits)
    return np.bincount(rows, weights=copies[columns], minlength=len(hits)).astype(np.int64)


def compared(group: pa.Table, dim: int, threshold: float) -> pa.Table:
    """Compare the left rows of a group with its right ones, or a block of members with itself: per node the links found
    (n), and links (node, other) that connect what is connected."""
    vectors = group.column("v").combine_chunks()
    vectors = unit(vectors, dim)
    node, copies, right = (group.column(c).to_numpy() for c in ("node", "copies", "right"))
    one, two = np.flatnonzero(~right), np.flatnonzero(right)
    i, j, members = (group.column(c)[0].as_py() for c in ("i", "j", "with"))
    inside = bool(members) and i == j
    if inside:
        two = one
    single = vectors.astype(np.float32)
    doubt = np.float32((dim + 8) * 2.0 ** -23)  # twice what single precision may be off
    counts, links = np.zeros(len(node), np.int64), []
    for i in range(0, len(one), TILE):
        for j in range(i if inside else 0, len(two), TILE):
            rows, columns = one[i:i + TILE], two[j:j + TILE]
            cosines = single[rows] @ single[columns].T
            if inside and i == j:
                cosines[np.tril_indices(len(rows))] = -2
            if cosines.max(initial=-2) < threshold - doubt:
                continue
            hits = cosines >= threshold + doubt
            a, b = np.nonzero((cosines >= threshold - doubt) & ~hits)
            for at in range(0, len(a), 1 << 14):
                x, y = a[at:at + (1 << 14)], b[at:at + (1 << 14)]
                hits[x, y] = (vectors[rows[x]] * vectors[columns[y]]).sum(axis=1) >= threshold
            if not hits.any():
                continue
            counts[rows] += weighted(hits, copies[columns])
            counts[columns] += weighted(hits.T, copies[rows])
            ends = np.concatenate([node[rows], node[columns]])
            links.append(np.stack([ends[e] for e in spanning(hits)]))
    some = np.flatnonzero(counts)
    a, b = np.concatenate(links, axis=1) if links else (np.zeros(0, np.int64),) * 2
    return pa.table([np.concatenate([node[some], a]), np.concatenate([counts[some], np.zeros(len(a), np.int64)]),
                     pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(b, pa.int64())])], schema=FOUND)


def _dealt(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Members and copies with the groups that they go to: place, i, j (blocks), kind, right. Kind 0 compares a block of
    members with a block of copies, kind 1 two blocks of members."""
    own = rows.join(F.broadcast(sizes), "place")  # a row per place
    block = F.pmod(F.xxhash64("node"), F.when(F.col("kind") == MEMBER, F.col("lefts")).otherwise(F.col("rights"))) \
        .cast("int")

    def upto(n: str) -> Column:
        return F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))

    def group(i: Column, j: Column, kind: int, right: Column) -> Column:
        return F.struct(i.alias("i"), j.alias("j"), F.lit(kind).alias("with"), right.alias("right"))

    me = F.col("_block")
    copies = F.transform(upto("lefts"), lambda i: group(i, me, 0, F.lit(True)))
    members = F.concat(
        F.transform(upto("rights"), lambda j: group(me, j, 0, F.lit(False))),
        F.transform(F.when(F.col("inner"), upto("lefts")).otherwise(F.array().cast("array<int>")),
                    lambda j: group(F.least(me, j), F.greatest(me, j), 1, me > j)))
    return own.withColumn("_block", block).select("place", F.inline(F.when(F.col("kind") == MEMBER, members)
                                                                    .otherwise(copies)), "node",
                                                  F.col("n").alias("copies"), "v")


def _pivots(classes: DataFrame, n: int, total: int, dim: int) -> np.ndarray:
    found = about(classes, n, total, "v").select("v").toArrow().column("v").combine_chunks()
    vectors = unit(found, dim)
    return vectors[np.lexsort(vectors.T)][np.random.default_rng(1).permutation(len(vectors))][:2 * n]


def linked_classes(classes: DataFrame, threshold: float, cores: int, cell: int, left: int, right: int) -> DataFrame:
    """For distinct vectors (node, copies, v): node, n (links of each copy), and the node's root."""
    spark = classes.sparkSession
    total, dim = classes.agg(F.count("*"), F.max(F.size("v"))).first()
    kind = "float" if "float" in classes.schema["v"].dataType.simpleString() else "double"
    n_cells = min(CELLS, ceil(total / cell))
    pivots = _pivots(classes, max(cores, n_cells), total, dim)
    places = Places(pivots[:cores], pivots[:n_cells], threshold)
    rows = written(placed(classes, places, dim, kind), "placed")
    for r in rows.groupBy("home").agg(F.sum("copies"), F.min("distance"), F.max("distance"), F.min("node")).collect():
        places.note(*r)  # a row per place
    out = written(sent(rows, places, dim, kind), "sent")
    counts: dict[int, list[int]] = {}
    meeting = out.filter(F.col("kind") <= COPY)
    for place, which, n in meeting.groupBy("place", "kind").agg(F.count("*")).collect():
        counts.setdefault(place, [0, 0])[which] = n
    scale = 64 / max(64, dim)
    lefts, rights = max(2, int(left * scale)), max(2, int(right * scale))
    sizes = spark.createDataFrame(
        [(p, ceil(m / lefts), ceil(c / rights), p >= places.n_cores) for p, (m, c) in counts.items()
         if m and (c or p >= places.n_cores)], "place int, lefts int, rights int, inner boolean")
    found = written(_dealt(meeting, sizes).groupBy("place", "i", "j", "with").applyInArrow(
        lambda group: compared(group, dim, threshold), "node long, n long, other long"), "compared")
    links = found.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")).unionByName(
        out.filter(F.col("kind") == LINK).select(F.col("node").alias("a"), F.col("n").alias("b")))
    gains = out.filter(F.col("kind") == GAIN).groupBy("place").agg(F.sum("n").alias("gain"))
    whole = out.filter(F.col("kind") == COUNT).select("place", "node", "n").join(
        F.broadcast(gains), "place", "left").select("node", (F.col("n") + F.coalesce("gain", F.lit(0))).alias("n"))
    sums = whole.unionByName(found.filter("other is null").select("node", "n")).groupBy("node").agg(F.sum("n").alias("n"))
    roots = written(connected_components(links), "roots")
    return sums.join(roots, "node", "left").select("node", "n", F.coalesce("root", "node").alias("root"))


def _results(docs: DataFrame, row: Column, threshold: float, id_col: str, vector_col: str, cores: int, cell: int,
             left: int, right: int) -> DataFrame:
    """row, id, n_links, component_id, keep_row (the row of the component that comes first by id)."""
    if not 0 < threshold < 1:
        raise ValueError("the threshold must be between 0 and 1")
    vector = F.col(vector_col)
    if "float" not in docs.schema[vector_col].dataType.simpleString():
        vector = vector.cast("array<double>")
    rows = written(docs.select(row.alias("row"), F.col(id_col).cast("long").alias("id"),
                               F.when(usable(vector), vector).alias("v")), "vectors")
    classes = written(rows.filter("v is not null").groupBy("v").agg(
        F.count("*").alias("copies"), F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("low"))
        .withColumn("node", F.monotonically_increasing_id()), "distinct-vectors")
    alone = rows.filter("v is null").select("row", "id", F.lit(0).cast("long").alias("n_links"),
                                            F.col("id").alias("component_id"), F.col("row").alias("keep_row"))
    if classes.isEmpty():
        return alone
    linked = written(linked_classes(classes, threshold, cores, cell, left, right), "linked")
    rooted = classes.select("node", "low").join(linked.select("node", "root"), "node")
    lowest = written(rooted.groupBy("root").agg(F.min("low").alias("least")), "lowest")
    found = classes.select("node", "v").join(linked, "node").join(lowest, "root").select(
        "v", F.col("n").alias("n_links"), F.col("least.id").alias("component_id"), F.col("least.row").alias("keep_row"))
    return rows.filter("v is not null").join(found, "v").select(alone.columns).unionByName(alone)


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding",
                    cores: int = CORES, cell: int = CELL, left: int = LEFT, right: int = RIGHT) -> DataFrame:
    """Per row: id, n_links, component_id (the smallest id reachable over links, its own included), kept (is it that id).

    A link joins two rows whose vectors have a cosine of at least ``threshold``. Vectors that are null, empty or zero,
    or that hold null, infinite or undefined components, link with nothing. A shorter vector counts as ending in zeros.
    Equal vectors are reduced to one that carries their number, so copies are never compared; repeated rows and rows
    that share an id each give a row. Rows without an id are linked like others; a component without any id has
    none, and its rows are kept. An empty table gives no rows; other columns are not read.
    """
    found = _results(docs, F.monotonically_increasing_id(), threshold, id_col, vector_col, cores, cell, left, right)
    return found.select(F.col("id").alias(id_col), "n_links", "component_id",
                        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding",
             cores: int = CORES, cell: int = CELL, left: int = LEFT, right: int = RIGHT) -> DataFrame:
    """One row of each component, the first by id, with all columns of ``docs``. Rows are told apart by their number in
    a stored copy, so of rows that share an id only those go that are copies."""
    own = free(docs, "_row")
    stored = written(docs.withColumn(own, F.monotonically_increasing_id()), "numbered")
    found = _results(stored, F.col(own), threshold, id_col, vector_col, cores, cell, left, right)
    gone = found.filter(F.col("row") != F.col("keep_row")).select(F.col("row").alias(own))
    return dropped(stored, gone, own).drop(own)
