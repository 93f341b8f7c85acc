"""Exact k-nearest-neighbour imputation without comparing all rows.

Donors are grouped into cells: same missing columns, then halved again and again
along the column that spreads most within a cell, until cells are small. A receiver first meets a cell near to it, whose k-th nearest
donor bounds its search (where that cell has fewer, a few real donors from all over do). Then it visits only cells whose bounding box
can hold a donor within that bound, so the result is that of the full comparison. Receivers and donors
meet by an equi-join on cell and chunk, block against block, and only the k best
of a block leave it. Equal points are searched once and, as donors, kept at most
k times, so copies cost nothing. Chunks bound what one task holds.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from derrick.functions.nearest import CellIndex, CellTree, block_nearest, matrix_of
from derrick.operators.window import k_nearest
from derrick.session import cut_lineage, passing, shuffle_width

CELL_ROWS = 1024
CHUNK_ROWS = 4096
BLOCK_ROWS = 1024
TASK_RECEIVERS = 20_000
ROUND_RECEIVERS = 1 << 23  # that are searched for at once, about: their meetings are shuffled, and fill no disk
MAX_CELLS = 16_384
MAX_PATTERNS = 256
LANDMARKS = 2048
COLUMN_FACTOR = 50  # landmarks per column and neighbour, where a column is rarely filled
MEETING = ["_cell", "_chunk"]
BATCH_BYTES = 1 << 22  # of results that leave a task together, about
TREE_ROWS = 1 << 17  # donors that the tree of cells is grown on, about; all are placed in it


def _missing(columns: list[str], test=any) -> Column:
    combine = or_ if test is any else (lambda a, b: a & b)
    return reduce(combine, [F.col(c).isNull() for c in columns])


def _profile(points: DataFrame, cols: list[str]) -> dict:
    """Rows, filled values and mean of every column, in one pass."""
    row = points.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(c).alias(f"n_{c}") for c in cols],
        *[F.avg(c).alias(f"m_{c}") for c in cols],
    ).first()
    return row.asDict()


def _pattern(cols: list[str]) -> Column:
    return F.concat(*[F.when(F.col(c).isNull(), F.lit("0")).otherwise(F.lit("1")) for c in cols])


def _grown(donors: DataFrame, cols: list[str], patterns: list[str], rows: int) -> CellTree:
    """The tree of cells, grown on about TREE_ROWS donors chosen by hash: it places every donor and only
    decides how even the cells are."""
    share = max(1, -(-rows // TREE_ROWS))
    chosen = donors.filter(F.pmod(F.xxhash64(*cols), F.lit(share)) == 0).select(*cols).toArrow()
    masks = np.array([[mark == "1" for mark in pattern] for pattern in patterns], dtype=bool).reshape(-1, len(cols))
    target = max(CELL_ROWS, -(-2 * rows // MAX_CELLS))
    return CellTree(matrix_of(chosen.columns), masks, rows, target, MAX_CELLS)


def _in_cells(donors: DataFrame, cols: list[str], tree: CellTree) -> DataFrame:
    """Add ``_cell``, the leaf of every row. Rare patterns start in one open cell, which is split as any other."""
    shared = donors.sparkSession.sparkContext.broadcast(vars(tree))

    def place(batches):
        cells_of = CellTree.of(shared.value)
        for batch in batches:
            cells = cells_of.place(matrix_of([batch.column(c) for c in cols]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.int32())], names=[*batch.schema.names, "_cell"])

    return donors.mapInArrow(place, T.StructType([*donors.schema.fields, T.StructField("_cell", T.IntegerType())]))


def _reduced_donors(df: DataFrame, cols: list[str], k: int, keys: list[str]) -> DataFrame:
    """At most k rows of every distinct point, those with the smallest keys: no
    other copy can be among the k nearest of anything."""
    same = Window.partitionBy(*cols).orderBy(*keys)
    filled = df.filter(~_missing(cols, all))
    return filled.withColumn("_copy", F.row_number().over(same)).filter(F.col("_copy") <= k).drop("_copy")


def _point(cols: list[str], bounds: bool) -> tuple[list[str], pa.DataType]:
    names = [*cols, *[f"_b_{c}" for c in cols]] if bounds else list(cols)
    return names, pa.struct([(c, pa.float64()) for c in names])


def _gathered(batches):
    """The same rows in batches of some megabytes: each batch that leaves a task costs as much as thousands of values."""
    waiting, size = [], 0
    for batch in batches:
        waiting.append(batch)
        size += batch.nbytes
        if size >= BATCH_BYTES:
            yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
            waiting, size = [], 0
    if waiting:
        yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()


def _met(receivers: DataFrame, cols: list[str], bounds: bool, pairs) -> DataFrame:
    """``_cell, _chunk, recv``: the receivers that meet a chunk, in blocks. ``pairs`` gives, for a batch,
    the rows and cells that meet and how many chunks of a cell count."""
    names, point = _point(cols, bounds)
    kind = pa.list_(point)
    rows_of_block = BLOCK_ROWS

    def assign(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, rows_of_block):
                part = batch.slice(start, rows_of_block)
                rows = pa.StructArray.from_arrays([part.column(c) for c in names], names=names)
                row, cell, chunks = pairs(part)
                order = np.argsort(cell, kind="stable")
                row, cell = row[order], cell[order]
                cells, firsts = np.unique(cell, return_index=True)
                for which, low, high in zip(cells, firsts, np.append(firsts[1:], len(cell)), strict=True):
                    chosen = rows.take(pa.array(row[low:high]))
                    one = pa.ListArray.from_arrays(pa.array([0, len(chosen)], pa.int32()), chosen)
                    times = int(chunks[which])
                    for at in range(0, times, 64):
                        chunk = np.arange(at, min(at + 64, times), dtype="int32")
                        repeat = pa.array(np.zeros(len(chunk), dtype="int64"))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(chunk), which), pa.int32()), pa.array(chunk), one.take(repeat).cast(kind)],
                            names=["_cell", "_chunk", "recv"],
                        )

    numbers = ", ".join(f"`{c}`: double" for c in names)
    return receivers.mapInArrow(lambda batches: _gathered(assign(batches)), f"_cell int, _chunk int, recv array<struct<{numbers}>>")


def _with_home(receivers: DataFrame, cols: list[str], shared) -> DataFrame:
    """Add ``_homes``, the cells near to a receiver in which a first bound is taken. They also put near receivers
    together, so that a block visits few cells."""

    def homes(batches):
        cells = CellIndex(*shared.value[0])
        for batch in batches:
            row, cell = cells.homes(matrix_of([batch.column(c) for c in cols]))
            at = pa.array(np.searchsorted(row, np.arange(batch.num_rows + 1)), pa.int32())
            found = pa.ListArray.from_arrays(at, pa.array(cell, pa.int32()))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in cols], found], names=[*cols, "_homes"])

    return receivers.mapInArrow(homes, ", ".join(f"`{c}` double" for c in cols) + ", _homes array<int>")


def _dealt(rows: DataFrame, tasks: int) -> DataFrame:
    """Rows by the chunk they belong to, in a given number of tasks: sizes in bytes say little about the comparing."""
    return rows.repartition(tasks, *MEETING)


def _merged(met: DataFrame) -> DataFrame:
    """Blocks that meet the same chunk put together up to BLOCK_ROWS receivers and one block more, so that the donors
    of a chunk are handed over for many receivers at once. Dealt rows stay where they are."""
    before = Window.partitionBy(*MEETING).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    slot = F.coalesce(F.sum(F.size("recv")).over(before), F.lit(0)) / BLOCK_ROWS
    slots = met.withColumn("_slot", slot.cast("long")).groupBy(*MEETING, "_slot")
    return slots.agg(F.flatten(F.collect_list("recv")).alias("recv")).drop("_slot")


def _bounded(receivers: DataFrame, cols: list[str], shared, chunked: DataFrame, k: int, centre, tasks: int, folder: str) -> DataFrame:
    """The receivers with ``_home`` and ``_b_<c>``: a distance that the k-th nearest donor for a missing ``c`` doesn't
    exceed, namely that of the k-th nearest in a chunk of the home cells."""
    middle = np.asarray(centre)

    def first_chunk(part):
        cell = part.column("_cell").to_numpy()
        return np.arange(len(cell)), cell, np.minimum(shared.value[1], 1)

    def bounds(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                points = batch.column("recv")[i].values.flatten()
                fields = dict(zip([f.name for f in batch.column("donors").type.value_type], batch.column("donors")[i].values.flatten()))
                left, right = matrix_of(points), matrix_of([fields[f"_v_{c}"] for c in cols])
                found = np.full(left.shape, np.nan)
                for column, receiver, _, distance in block_nearest(left, right, k, middle):
                    last = np.flatnonzero(np.append(receiver[1:] != receiver[:-1], True)) if len(receiver) else receiver
                    full = last[np.diff(np.append(-1, last)) == k]
                    found[receiver[full], column] = distance[full]
                yield pa.RecordBatch.from_arrays([*points, *[pa.array(c, from_pandas=True) for c in found.T]], names=names)

    names, _ = _point(cols, True)
    order = ["_cell", *cols]
    spread = receivers.select(*cols, F.explode("_homes").alias("_cell")).repartitionByRange(tasks, *order).sortWithinPartitions("_cell")
    firsts = chunked.filter(F.col("_chunk") == 0)  # no other is met here
    meetings = _merged(_dealt(_met(spread, cols, False, first_chunk), tasks)).join(_dealt(firsts, tasks), MEETING)
    probed = meetings.select("recv", "donors").mapInArrow(lambda batches: _gathered(bounds(batches)), ", ".join(f"`{c}` double" for c in names))
    none = F.lit(None)
    own = receivers.select(*cols, *[none.cast("double").alias(f"_b_{c}") for c in cols], F.try_element_at("_homes", F.lit(1)).alias("_home"))
    both = own.unionByName(probed.withColumn("_home", none.cast("int")))
    return cut_lineage(both.groupBy(*cols).agg(*[F.min(f"_b_{c}").alias(f"_b_{c}") for c in cols], F.max("_home").alias("_home")), folder)


def _blocks(bounded: DataFrame, cols: list[str], shared, tasks: int) -> DataFrame:
    """``_cell, _chunk, recv``: the receivers that visit a chunk, in blocks of near ones.

    The number of tasks is given, for the work lies in the comparing, not in the bytes.
    """

    built = []  # the index, once per task

    def visited(part):
        index, chunks = shared.value
        if not built:
            built.append(CellIndex(*index))
        x, known = (matrix_of([part.column(f"{mark}{c}") for c in cols]) for mark in ("", "_b_"))
        return *built[0].pairs(x, known), chunks

    near = bounded.repartitionByRange(tasks, *[F.col(c) for c in ("_home", *cols)]).sortWithinPartitions("_home")
    return _met(near, cols, True, visited)


def _best_of_blocks(meetings: DataFrame, cols: list[str], keys: list[T.StructField], k: int, centre) -> DataFrame:
    """For each block and chunk that meet: the k best donors per missing cell."""
    middle = np.asarray(centre)
    names = [f.name for f in keys]

    def nearest(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                receivers = batch.column("recv")[i].values
                donors = batch.column("donors")[i].values
                points = receivers.flatten()
                points, known = points[: len(cols)], matrix_of(points[len(cols) :])
                fields = dict(zip([f.name for f in donors.type], donors.flatten()))
                left, right = matrix_of(points), matrix_of([fields[f"_v_{c}"] for c in cols])
                for column, receiver, donor, distance in block_nearest(left, right, k, middle, known):
                    if not len(receiver):
                        continue
                    who, whom = pa.array(receiver), pa.array(donor)
                    yield pa.RecordBatch.from_arrays(
                        [
                            *[p.take(who) for p in points],
                            pa.array([cols[column]] * len(receiver), pa.string()),
                            pa.array(distance, pa.float64()),
                            *[fields[f"_k_{n}"].take(whom) for n in names],
                            pa.array(right[donor, column], pa.float64()),
                        ],
                        names=[*[f"_p_{c}" for c in cols], "column", "dist", *[f"donor_{n}" for n in names], "value"],
                    )

    shape = T.StructType(
        [T.StructField(f"_p_{c}", T.DoubleType()) for c in cols]
        + [T.StructField("column", T.StringType()), T.StructField("dist", T.DoubleType())]
        + [T.StructField(f"donor_{f.name}", f.dataType) for f in keys]
        + [T.StructField("value", T.DoubleType())]
    )
    return meetings.select("recv", "donors").mapInArrow(lambda batches: _gathered(nearest(batches)), shape)


def _neighbours(
    df: DataFrame,
    known: DataFrame,
    cols: list[str],
    k: int,
    keys: list[str],
    profile: dict,
    finish: Callable[[DataFrame], DataFrame],
    within: str | None = None,
) -> DataFrame:
    """``finish`` of ``_p_<c>.., column, rank, dist, donor_<key>.., value`` for every distinct
    incomplete point of ``df``, ``_p_<c>`` being its coordinates; the donors are
    the rows of ``known``. Keys are given as ``_k_<key>``. Receivers are searched for in rounds, and the tables
    and shuffles of a step go when the next has been written; only what ``finish`` gives stays (``within`` a folder)."""
    spark = df.sparkSession
    held = [f"_k_{c}" for c in keys]
    key_fields = [T.StructField(c, df.schema[f"_k_{c}"].dataType) for c in keys]
    centre = np.array([profile[f"m_{c}"] for c in cols])
    with passing(spark) as folder:
        with passing(spark) as first:
            donors = cut_lineage(_reduced_donors(known, cols, k, held), first)
            counted = donors.groupBy(_pattern(cols).alias("_pattern")).agg(F.count(F.lit(1)).alias("n"))
            common = counted.orderBy(F.desc("n"), "_pattern").limit(MAX_PATTERNS).collect()
            tree = _grown(donors, cols, [r["_pattern"] for r in common], donors.count())
            landmarks = _landmarks(donors, cols, held, k)
            placed = cut_lineage(_in_cells(donors, cols, tree), first)

            numbers = {c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in cols}
            boxes = placed.groupBy("_cell").agg(
                F.count(F.lit(1)).alias("n"), *[F.min(v).alias(f"l_{c}") for c, v in numbers.items()], *[F.max(v).alias(f"h_{c}") for c, v in numbers.items()]
            )
            summary = boxes.toArrow().combine_chunks()  # at most MAX_CELLS rows and a few for the patterns
            low, high = (matrix_of([summary.column(f"{side}_{c}") for c in cols]) for side in "lh")
            low, high, sizes = tree.boxes(summary.column("_cell").to_numpy(), low, high, summary.column("n").to_numpy())

            chunks = -(-sizes // CHUNK_ROWS)
            index = (low, high, tree.opened, landmarks, centre, k, vars(tree), sizes)
            shared = spark.sparkContext.broadcast((index, chunks))
            leaves = summary.column("_cell").to_numpy()
            counts = spark.createDataFrame(list(zip(leaves.tolist(), chunks[leaves].tolist())), "_cell int, _chunks bigint")
            record = F.struct(*held, *[F.col(c).alias(f"_v_{c}") for c in cols])
            chunked = cut_lineage(
                placed.join(F.broadcast(counts), "_cell")  # at most MAX_CELLS rows
                .withColumn("_chunk", F.pmod(F.xxhash64(*cols, *held), F.col("_chunks")).cast("int"))
                .groupBy("_cell", "_chunk")
                .agg(F.sort_array(F.collect_list(record)).alias("donors")),
                folder,
            )
        receivers = df.filter(_missing(cols) & ~_missing(cols, all)).select(*cols).distinct()
        homed = cut_lineage(_with_home(receivers, cols, shared), folder)
        missing = sum(profile["rows"] - profile[f"n_{c}"] for c in cols)
        rounds = max(1, -(-homed.count() // ROUND_RECEIVERS))
        tasks = max(shuffle_width(spark), min(profile["rows"], missing) // rounds // TASK_RECEIVERS)
        home = F.coalesce(F.try_element_at("_homes", F.lit(1)), F.lit(0))  # near receivers share a round
        by = [*[f"_p_{c}" for c in cols], "column"]
        found = []
        for part in range(rounds):
            with passing(spark) as current:
                mine = homed.filter(F.pmod(home, F.lit(rounds)) == part) if rounds > 1 else homed
                bounded = _bounded(mine, cols, shared, chunked, k, centre, tasks, current)
                meetings = _merged(_dealt(_blocks(bounded, cols, shared, tasks), tasks)).join(_dealt(chunked, tasks), MEETING)
                best = _best_of_blocks(meetings, cols, key_fields, k, centre)
                found.append(cut_lineage(finish(k_nearest(best, by, ["dist", *[f"donor_{c}" for c in keys]], k)), within))
    return reduce(DataFrame.unionAll, found)


def _landmarks(donors: DataFrame, cols: list[str], held: list[str], k: int) -> np.ndarray:
    """Real donors, chosen by hash: some of all, and more of each column that the
    first choice rarely fills, so that every column has a bound on its k-th nearest."""

    def choice(rows: DataFrame, n: int) -> dict[tuple, tuple]:
        chosen = rows.orderBy(F.xxhash64(*cols), *held).limit(n).select(*held, *cols).collect()
        return {tuple(r[: len(held)]): tuple(r[len(held) :]) for r in chosen}

    found = choice(donors, LANDMARKS)
    for i, c in enumerate(cols):
        filled = sum(values[i] is not None for values in found.values())
        if filled < min(len(found), k * COLUMN_FACTOR):
            # By key, as a donor that counts twice would make a bound too small.
            found |= choice(donors.filter(F.col(c).isNotNull()), k * COLUMN_FACTOR)
    return np.array([[np.nan if v is None else v for v in values] for values in found.values()], float).reshape(-1, len(cols))


def _prepared(df: DataFrame, cols: list[str], keys: list[str], donors: Column | None = None):
    """Columns as doubles beside untouched keys (a key may be a column too), the
    donor rows, the columns that hold any value, and the profile of the donors."""
    held = {f"_k_{c}": F.col(c) for c in keys}
    points = df.withColumns(held | {c: F.col(c).cast("double") for c in cols})
    known = points if donors is None else points.filter(donors)
    profile = _profile(known, cols)
    return points, known, [c for c in cols if profile[f"n_{c}"]], profile


def _same_point(cols: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_p_{c}")) for c in cols])


def knn_pairs(df: DataFrame, cols: list[str], k: int, keys: list[str]) -> DataFrame:
    """``<keys>, column, rank, dist, donor_<keys>, value``: the k nearest donors
    of every missing cell. Ties in distance go to the smaller donor key."""
    points, known, usable, profile = _prepared(df, cols, keys)
    own = [F.col(f"_k_{c}").alias(c) for c in keys]
    if all(profile[f"n_{c}"] == profile["rows"] for c in usable):
        theirs = [F.col(f"_k_{c}").alias(f"donor_{c}") for c in keys]
        return points.limit(0).select(
            *own, F.lit("").alias("column"), F.lit(0).alias("rank"), F.lit(0.0).alias("dist"), *theirs, F.lit(0.0).alias("value")
        )
    plain = points.select(*[f"_k_{c}" for c in keys], *usable)
    found = _neighbours(plain, plain, usable, k, keys, profile, lambda found: found)
    rows = plain.filter(_missing(usable))
    return rows.join(found, _same_point(usable)).select(
        *own, "column", "rank", "dist", *[f"donor_{c}" for c in keys], "value"
    )


def knn_impute(
    df: DataFrame, cols: list[str], keys: list[str], k: int = 5, donors: Column | None = None, within: str | None = None
) -> DataFrame:
    """Fill missing values of ``cols`` by the mean of the k nearest donors.

    A cell without any comparable donor gets the column mean; a column that is
    empty throughout stays empty. ``keys`` identify a row. Columns are not scaled.
    ``donors`` restricts the donors (and the means) to rows that meet a condition.
    The frame is read several times: give a stored one, or cut its lineage. The values found are
    kept ``within`` a folder.
    """
    points, known, usable, profile = _prepared(df, cols, keys, donors)
    filled = profile if donors is None else _profile(points, cols)
    gaps = [c for c in usable if filled[f"n_{c}"] < filled["rows"]]
    if not gaps:
        return points.select(*df.columns)
    narrow = [*[f"_k_{c}" for c in keys], *usable]
    point = [f"_p_{c}" for c in usable]

    def fillings(found: DataFrame) -> DataFrame:
        # Added in rank order, so the mean has the same bits on every run.
        ordered = F.sort_array(F.collect_list(F.struct("rank", "value")))
        means = found.groupBy(*point, "column").agg(
            (F.aggregate(ordered, F.lit(0.0), lambda s, v: s + v["value"]) / F.count("value")).alias("mean")
        )
        return means.groupBy(*point).agg(*[F.max(F.when(F.col("column") == c, F.col("mean"))).alias(f"_f_{c}") for c in gaps])

    repairs = _neighbours(points.select(*narrow), known.select(*narrow), usable, k, keys, profile, fillings, within)
    complete = points.filter(~_missing(usable))
    repaired = (
        points.filter(_missing(usable))
        .join(repairs, _same_point(usable), "left")
        .withColumns({c: F.coalesce(c, f"_f_{c}", F.lit(profile[f"m_{c}"])) for c in gaps})
    )
    return complete.select(*df.columns).unionByName(repaired.select(*df.columns))
