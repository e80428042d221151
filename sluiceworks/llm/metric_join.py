"""Near duplicates of vectors by an exact metric range join.

Unit vectors with a cosine of at least c lie within the distance r = sqrt(2 - 2c) of each other.

1. Pivots are taken from a bounded sample of each label, dense places first. A dense pivot is moved to
   the middle of its neighbours, so that a group of near copies has a pivot in its midst.
2. Every vector goes to the cell of its nearest pivot. It is replicated to another cell, of larger
   number, if it may be within r of a vector there: if it is no further than r from the plane between
   the two pivots and no further than r plus the cell's radius from its pivot.
3. The vectors within r/2 of their pivot are the cell's core. By the triangle inequality they are all
   linked to each other and to nothing beyond 3r/2 from the pivot. So they are counted, not compared,
   and stand as one node in the search for components.
4. Cells, in blocks of bounded size, are joined independently: the vectors of a block are held, the
   others stream past. Each block gives the numbers of links and a spanning forest of what it saw.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceworks.llm.arrow_words import mix
from sluiceworks.llm.near_dedup import components
from sluiceworks.llm.tables import modest_batches, release, stored

LEAST = 0.93
SAMPLE = 4096  # vectors that pivots are chosen from, about
PIVOTS = 1024  # pivots at most
CELL_ROWS = 1024  # vectors of a cell, as far as there are pivots for that
BLOCK = 1024  # vectors that a task holds, about
DENSE = 8  # sampled vectors within r/2 that make a place dense
SLACK = 1e-7  # distances are roots of differences, so exact to some 1e-8
KEY = ["label", "width", "cell", "block"]


def unit_rows(column: pa.Array, width: int) -> np.ndarray:
    """Vectors of one width, scaled to length 1 in double precision."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that no square overflows
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def distance(dots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * dots, 0))


@dataclass
class Cells:
    """The cells of a label. ``first`` is the number of the first one."""

    first: int
    pivots: np.ndarray
    rest: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # vectors outside the core
    core: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # vectors in the core
    radius: np.ndarray = field(default_factory=lambda: np.zeros(0))
    smallest: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # id in the core

    def home(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(nearest pivot, distances to all pivots)."""
        dots = x @ self.pivots.T
        return dots.argmax(axis=1), distance(dots)

    def reached(self, home: np.ndarray, far: np.ndarray, reach: float) -> np.ndarray:
        """Which other cells, of larger number, may have vectors within ``reach``."""
        between = distance(self.pivots @ self.pivots.T)
        own = far[np.arange(len(far)), home]
        gap = 2 * between[home] * (reach + SLACK)
        plane = far**2 - own[:, None] ** 2 <= gap + SLACK
        ball = far <= self.radius + reach + SLACK
        return plane & ball & (np.arange(len(self.pivots)) > home[:, None])


def choose_pivots(x: np.ndarray, wanted: int, half: float) -> np.ndarray:
    """Up to ``wanted`` pivots, and one for each dense place, more than ``half`` apart when chosen."""
    n = len(x)
    near = 1 - half * half / 2
    density = np.concatenate([(x[a : a + 512] @ x.T >= near).sum(axis=1) for a in range(0, n, 512)])
    free, out = np.ones(n, bool), []
    for i in np.argsort(-density, kind="stable").tolist():
        if not free[i]:
            continue
        if density[i] < DENSE and len(out) >= wanted:
            break
        around = x @ x[i] >= near
        free &= ~around
        pivot = x[i]
        if density[i] >= DENSE:
            middle = x[around].mean(axis=0)
            pivot = middle / np.sqrt((middle * middle).sum())
        out.append(pivot)
    return np.stack(out)


def _labels_of(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], np.ndarray]]:
    """((label, width), rows) of the groups of a batch with columns label and width."""
    label, width = batch.column("label").dictionary_encode(), batch.column("width").to_numpy()
    code = label.indices.to_numpy()
    names = label.dictionary.to_pylist()
    for pair in np.unique(np.stack([code, width], axis=1), axis=0).tolist():
        yield (names[pair[0]], pair[1]), np.flatnonzero((code == pair[0]) & (width == pair[1]))


def _homes(cells: dict[tuple[str, int], Cells], half: float):
    """Rows with their home cell, -1 if the label has no pivots, and the distance from its pivot.

    What is in a core is decided here once: another product of the same vectors may differ in its last bit.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            cell, core, far = np.full(n, -1, np.int32), np.zeros(n, bool), np.zeros(n)
            for key, rows in _labels_of(batch):
                if own := cells.get(key):
                    x = unit_rows(batch.column("embedding").take(pa.array(rows)), key[1])
                    home, all_far = own.home(x)
                    far[rows] = all_far[np.arange(len(rows)), home]
                    cell[rows] = own.first + home
                    core[rows] = far[rows] <= half
            parts = [batch.column(c) for c in ("vec_id", "label", "width", "embedding")]
            parts += [pa.array(cell), pa.array(core), pa.array(far)]
            yield pa.RecordBatch.from_arrays(
                parts, ["vec_id", "label", "width", "embedding", "cell", "core", "far"]
            )

    return run


def _blocks(n: np.ndarray, block: int) -> np.ndarray:
    return -(-n // block)


def _spread(rows: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the numbers from its ``first`` up to below its ``last``: (place in rows, number)."""
    n = np.maximum(last - first, 0)
    place = np.repeat(np.arange(len(rows)), n)
    return place, np.arange(len(place)) - np.repeat(np.cumsum(n) - n, n) + first[place]


def _dealt(cells: dict[tuple[str, int], Cells], reach: float, half: float, block: int):
    """Rows of homes to the blocks that hold them (role 0) and that they stream past (role 1).

    Blocks 0, 1, ... of a cell hold what is outside its core, blocks -1, -2, ... the core. ``node`` is
    what the vector is in the search for components.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, all_homes = (batch.column(c).to_numpy() for c in ("vec_id", "cell"))
            all_cores = batch.column("core").to_numpy(zero_copy_only=False)
            for key, rows in _labels_of(batch):
                own = cells.get(key)
                if own is None:
                    continue
                _, far = own.home(unit_rows(batch.column("embedding").take(pa.array(rows)), key[1]))
                home, core = all_homes[rows] - own.first, all_cores[rows]
                n_rest, n_core = _blocks(own.rest, block), _blocks(own.core, block)
                blocks = np.where(core, n_core[home], n_rest[home]).astype(np.uint64)
                dealt = (mix(ids[rows].view(np.uint64)) % blocks).astype(np.int64)
                node = np.where(core, own.smallest[home], ids[rows])
                close = far <= reach + half + SLACK  # to the cores that a vector may be linked to
                outside = np.flatnonzero(~core)
                none = np.zeros(len(outside), np.int64)
                taken = [(np.arange(len(rows)), home, np.where(core, -1 - dealt, dealt), 0)]
                k, b = _spread(outside, dealt[outside] + 1, n_rest[home[outside]])
                taken.append((outside[k], home[outside[k]], b, 1))
                k, b = _spread(outside, none, n_core[home[outside]] * close[outside, home[outside]])
                taken.append((outside[k], home[outside[k]], -1 - b, 1))
                row, cell = np.nonzero(own.reached(home, far, reach))
                none = np.zeros(len(row), np.int64)
                k, b = _spread(row, none, n_rest[cell])
                taken.append((row[k], cell[k], b, 1))
                k, b = _spread(row, none, n_core[cell] * close[row, cell])
                taken.append((row[k], cell[k], -1 - b, 1))
                row, cell, number = (np.concatenate([t[i] for t in taken]) for i in range(3))
                role = np.concatenate([np.full(len(t[0]), t[3], np.int32) for t in taken])
                for a in range(0, len(row), 4096):
                    part = slice(a, a + 4096)
                    out = batch.take(pa.array(rows[row[part]]))
                    yield pa.RecordBatch.from_arrays(
                        [
                            *[out.column(c) for c in ("vec_id", "label", "width", "embedding")],
                            pa.array((own.first + cell[part]).astype(np.int32)),
                            pa.array(number[part].astype(np.int32)),
                            pa.array(role[part]),
                            pa.array(node[row[part]]),
                        ],
                        ["vec_id", "label", "width", "embedding", "cell", "block", "role", "node"],
                    )

    return run


class Block:
    """The vectors that a task holds, and what is linked to them."""

    def __init__(self, least: float, core: bool):
        self.least, self.core = least, core
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.x: np.ndarray | None = None
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # (id, links, node it belongs to)

    def hold(self, ids: np.ndarray, nodes: np.ndarray, x: np.ndarray) -> None:
        self.parts.append((ids, nodes, x))

    def close(self) -> None:
        """All that the block holds is there: link it among itself."""
        self.ids, self.nodes, self.x = (np.concatenate([p[i] for p in self.parts]) for i in range(3))
        self.parts = []
        self.links = np.zeros(len(self.ids), np.int64)
        self.root = np.arange(len(self.ids))
        if not self.core:
            for a in range(0, len(self.ids), 512):
                linked = self.x @ self.x[a : a + 512].T >= self.least
                linked[np.arange(a, a + linked.shape[1]), np.arange(linked.shape[1])] = False
                self.links += linked.sum(axis=1)
                own = np.arange(a, a + linked.shape[1])
                first, some = linked.argmax(axis=0), linked.any(axis=0)
                self._join(own[some], first[some])
                self._join_rows(linked, first)

    def _join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Merge the trees of held vectors ``a`` and ``b``, pairwise."""
        pairs = np.unique(np.stack([self.root[a], self.root[b]], axis=1), axis=0)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        if not len(pairs):
            return
        up: dict[int, int] = {}

        def top(k: int) -> int:
            while k in up:
                k = up[k]
            return k

        for p, q in pairs.tolist():
            p, q = top(p), top(q)
            if p != q:
                up[max(p, q)] = min(p, q)
        for k in up:
            self.root[self.root == k] = top(k)

    def _join_rows(self, linked: np.ndarray, first: np.ndarray) -> None:
        row, column = np.nonzero(linked & (self.root[:, None] != self.root[first][None, :]))
        self._join(row, first[column])

    def pass_by(self, ids: np.ndarray, nodes: np.ndarray, x: np.ndarray) -> None:
        if self.x is None:
            self.close()
        linked = self.x @ x.T >= self.least
        some = np.flatnonzero(linked.any(axis=0))
        if not len(some):
            return
        linked = linked[:, some]
        self.links += linked.sum(axis=1)
        first = linked.argmax(axis=0)
        self.found.append((ids[some], linked.sum(axis=0), nodes[some], self.nodes[first]))
        if not self.core:
            self._join_rows(linked, first)

    def result(self) -> pa.RecordBatch:
        """Rows (vec_id, links, a, b): its links in this block, and an edge between two nodes."""
        if self.x is None:
            self.close()
        own = (self.links > 0) | (self.root != np.arange(len(self.root)))
        rows = [(self.ids[own], self.links[own], self.nodes[own], self.nodes[self.root[own]]), *self.found]
        columns = [np.concatenate([r[i] for r in rows]) for i in range(4)]
        return pa.RecordBatch.from_arrays(
            [pa.array(c.astype(np.int64)) for c in columns], ["vec_id", "links", "a", "b"]
        )


def _linked(least: float):
    """Rows sorted by KEY and role, so a block is held before the others pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, block = None, None
        for batch in batches:
            label = batch.column("label").dictionary_encode()
            names = label.dictionary.to_pylist()
            keys = [label.indices.to_numpy()]
            keys += [batch.column(c).to_numpy() for c in (*KEY[1:], "role")]
            keys = np.stack(keys, axis=1)
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(keys)], strict=True):
                name, width, cell, number, role = keys[a].tolist()
                key = (names[name], width, cell, number)
                if key != now:
                    if block:
                        yield block.result()
                    now, block = key, Block(least, number < 0)
                part = batch.slice(a, b - a)
                x = unit_rows(part.column("embedding"), width)
                ids, nodes = (part.column(c).to_numpy() for c in ("vec_id", "node"))
                if role:
                    block.pass_by(ids, nodes, x)
                else:
                    block.hold(ids, nodes, x)
        if block:
            yield block.result()

    return run


def _usable(vectors: DataFrame) -> Column:
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists("embedding", lambda x: x != 0)
    return F.coalesce(F.col("label").isNotNull() & sound & some, F.lit(False))


def _one_of_each(rows: DataFrame) -> DataFrame:
    """One row of each vec_id."""
    again = rows.groupBy("vec_id").count().where("count > 1").select("vec_id")
    if again.isEmpty():
        return rows
    first = rows.join(again, "vec_id", "left_semi").groupBy("vec_id").agg(
        F.min(F.struct("label", "embedding")).alias("row")
    )
    return rows.join(again, "vec_id", "left_anti").unionByName(first.select("vec_id", "row.*"))


def _cells(rows: DataFrame, sample: int, pivots: int, cell_rows: int, half: float) -> dict[tuple[str, int], Cells]:
    """Pivots for each label and width that the sample has."""
    n = rows.count()
    share = min(1.0, sample / max(n, 1))
    parts = 1 << 30
    picked = rows.where(F.pmod(F.xxhash64(F.lit("pivots"), "vec_id"), F.lit(parts)) < int(share * parts))
    taken = picked.select("label", "width", "vec_id", "embedding").toArrow()
    groups: dict[tuple[str, int], np.ndarray] = {}
    for batch in taken.sort_by("vec_id").combine_chunks().to_batches():
        for key, at in _labels_of(batch):
            x = unit_rows(batch.column("embedding").take(pa.array(at)), key[1])
            groups[key] = np.concatenate([groups[key], x]) if key in groups else x
    cells, first = {}, 0
    cell_rows = max(cell_rows, -(-n // pivots))
    for key in sorted(groups, key=lambda k: (-len(groups[k]), k)):
        x = groups[key]
        wanted = max(1, min(len(x), round(len(x) / share / cell_rows)))
        chosen = choose_pivots(x, wanted, half)[: pivots - first]
        if not len(chosen):
            break
        cells[key] = Cells(first, chosen)
        first += len(chosen)
    return cells


def _fill(cells: dict[tuple[str, int], Cells], homes: DataFrame) -> None:
    """Count the cells that have pivots."""
    sums = homes.where("cell >= 0").groupBy("cell").agg(
        F.count_if("core").alias("core"),
        F.count_if(~F.col("core")).alias("rest"),
        F.max("far").alias("radius"),
        F.min(F.when(F.col("core"), F.col("vec_id"))).alias("smallest"),
    )
    found = {r["cell"]: r for r in sums.collect()}  # as many as there are pivots at most
    for own in cells.values():
        rows = [found.get(own.first + k) for k in range(len(own.pivots))]
        own.core = np.array([r["core"] if r else 0 for r in rows], np.int64)
        own.rest = np.array([r["rest"] if r else 0 for r in rows], np.int64)
        own.radius = np.array([r["radius"] if r else -9.0 for r in rows])
        own.smallest = np.array([r["smallest"] or 0 if r else 0 for r in rows], np.int64)


def _without_pivots(homes: DataFrame, block: int) -> DataFrame:
    """The vectors of labels that the sample lacks: a cell for each label, in blocks."""
    rows = homes.where("cell < 0").drop("cell")
    counted = rows.groupBy("label", "width").agg(
        F.ceil(F.count("*") / block).cast("int").alias("blocks")
    )
    number = F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")
    later = F.when(F.col("own") + 1 < F.col("blocks"), F.sequence(F.col("own") + 1, F.col("blocks") - 1))
    dealt = rows.join(counted, ["label", "width"]).withColumn("own", number)
    every = F.concat(F.array("own"), F.coalesce(later, F.array().cast("array<int>")))
    return dealt.select("*", F.explode(every).alias("block")).select(
        "vec_id",
        "label",
        "width",
        "embedding",
        F.lit(-1).alias("cell"),
        "block",
        (F.col("block") != F.col("own")).cast("int").alias("role"),
        F.col("vec_id").alias("node"),
    )


def near_vectors(
    vectors: DataFrame,
    least: float = LEAST,
    sample: int = SAMPLE,
    pivots: int = PIVOTS,
    cell_rows: int = CELL_ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """vec_id, n_links, component_id, kept for each vec_id of ``vectors`` (vec_id, embedding, label, ...).

    Two vectors are linked if their labels and widths are equal and their cosine, in double precision, is
    ``least`` (over 0, under 1) or more. ``n_links`` counts the others linked directly, component_id is the
    smallest vec_id that links lead to, itself included, and kept says that it is the row's own.
    Vectors that are null, empty, zero or hold a null or a value that isn't finite, and those with a null
    label, are linked with nothing. Rows that share a vec_id are one vector: the one with the smallest
    label, then the smallest embedding, nulls first, stands for all. Rows without vec_id have no links and
    no component and are kept, each for itself. An empty table gives an empty result. Other columns
    aren't read.

    ``sample`` bounds what the pivots are chosen from, and only that; all vectors are joined. ``pivots``
    and the width of the vectors bound what the tasks are sent.
    """
    if not 0 < least < 1:
        raise ValueError("a cosine between 0 and 1 is needed")
    spark = vectors.sparkSession
    modest_batches(spark)
    reach = float(np.sqrt(2 - 2 * least))
    half = reach / 2 - SLACK
    kind = vectors.schema["embedding"].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    all_rows = vectors.select(
        F.col("vec_id").cast("long"),
        F.col("label").cast("string"),
        F.col("embedding").cast("array<float>" if single else "array<double>"),
    )
    named = _one_of_each(all_rows.where("vec_id IS NOT NULL"))
    rows = named.where(_usable(named)).withColumn("width", F.size("embedding"))
    cells = _cells(rows, sample, pivots, cell_rows, half)
    kind = f"vec_id long, label string, width int, embedding array<{'float' if single else 'double'}>"
    homes = stored(
        spark, rows.mapInArrow(_homes(cells, half), f"{kind}, cell int, core boolean, far double"), "homes"
    )
    _fill(cells, homes)
    dealt = homes.mapInArrow(
        _dealt(cells, reach, half, block), f"{kind}, cell int, block int, role int, node long"
    )
    if not homes.where("cell < 0").isEmpty():
        dealt = dealt.unionByName(_without_pivots(homes, block))
    met = dealt.repartition(*KEY).sortWithinPartitions(*KEY, "role")
    found = stored(
        spark, met.mapInArrow(_linked(least), "vec_id long, links long, a long, b long"), "links"
    )
    release(spark)
    counts = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    edges = found.select(F.col("a").alias("centre"), F.col("b").alias("member")).where("centre <> member")
    links = stored(spark, edges.distinct(), "links")
    labels = stored(spark, components(spark, links), "labels")
    return _result(spark, all_rows, homes, cells, counts, labels)


def _result(
    spark: SparkSession,
    all_rows: DataFrame,
    homes: DataFrame,
    cells: dict[tuple[str, int], Cells],
    counts: DataFrame,
    labels: DataFrame,
) -> DataFrame:
    groups = [
        (own.first + k, int(own.core[k]) - 1, int(own.smallest[k]))
        for own in cells.values()
        for k in np.flatnonzero(own.core).tolist()
    ]
    cores = spark.createDataFrame(groups, "cell int, others long, node long")
    cores = cores.join(labels, "node", "left").select(
        "cell", "others", F.coalesce("component", "node").alias("core_component"), F.lit(True).alias("core")
    )
    ids = all_rows.where("vec_id IS NOT NULL").select("vec_id").distinct()
    in_core = homes.where("core").select("vec_id", "cell", "core")
    out = (
        ids.join(in_core, "vec_id", "left")
        .join(F.broadcast(cores), ["cell", "core"], "left")  # a row for each pivot at most
        .join(counts, "vec_id", "left")
        .join(labels.withColumnRenamed("node", "vec_id"), "vec_id", "left")
        .select(
            "vec_id",
            (F.coalesce("links", F.lit(0)) + F.coalesce("others", F.lit(0))).alias("n_links"),
            F.coalesce("core_component", "component", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id") == F.col("component_id"))
    )
    nameless = all_rows.where("vec_id IS NULL").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
    )
    return out.unionByName(nameless)
