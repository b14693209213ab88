"""k-nearest-neighbour imputation as an exact, pruned block join.

Distances compare only coordinates known in both rows: sqrt(p / shared * sum of squared differences).
Equal rows are merged with their count first. Donors are laid out in a grid of quantile cells; for each
incomplete row the boxes of the cells give an upper bound of the k-th distance, and only cells that can
come closer are visited. Visits and donors meet as packed blocks, each scored as one matrix, and only k
candidates per row and block go on. No donor is ever left out that could be among the nearest.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.missing import nan_to_null
from millrace.operators.split import bucket_of
from millrace.session import settle

#: Columns, and gaps of patterns, up to which the donors of a pattern are laid out in cells; beyond, blocks of rows meet.
MAX_COLUMNS, MAX_TASKS = 30, 2000
#: Receivers and donors of one task of the grid of blocks, and rows of a packed block.
WIDE_RECEIVERS, WIDE_DONORS, PACK = 2048, 16_384, 1024
CELLS = 65_536
RECEIVERS = 256


class Task(NamedTuple):
    """One missing column of one pattern of gaps."""

    number: int
    pattern: int
    target: int
    known: tuple[int, ...]


def _pattern(cols: Sequence[str]) -> Column:
    return sum((F.when(F.col(c).isNull(), 1 << i).otherwise(0) for i, c in enumerate(cols)), F.lit(0))


def _axes(values: np.ndarray, other: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Coordinates the receivers know (the same for all of a task), with the donors or cells that know them."""
    return [(i, ~np.isnan(other[:, i])) for i in np.flatnonzero(~np.isnan(values[0]))]


def _gaps(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest possible distance of each row to the box of each cell."""
    near, far = np.zeros((2, len(values), len(lo)))
    shared = np.zeros(len(lo))
    for i, there in _axes(values, lo):
        v, a, b = values[:, i, None], np.where(there, lo[:, i], 0.0), np.where(there, hi[:, i], 0.0)
        below, above = a - v, v - b
        near += np.maximum(np.maximum(below, above), 0.0) ** 2 * there
        far += np.maximum(np.abs(below), np.abs(above)) ** 2 * there
        shared += there
    scale = p / np.maximum(shared, 1)
    return np.sqrt(near * scale), np.sqrt(far * scale)


def _nearest(r: np.ndarray, d: np.ndarray, target: np.ndarray, k: int, p: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Receiver, donor and distance of the k nearest donors of each receiver, ties by the smaller value."""
    total, shared = np.zeros((len(r), len(d))), np.zeros(len(d))
    for i, there in _axes(r, d):
        total += (r[:, i, None] - np.where(there, d[:, i], 0.0)) ** 2 * there
        shared += there
    distance = np.sqrt(total * (p / shared))
    if len(d) > k:
        row, col = np.nonzero(distance <= np.partition(distance, k - 1, axis=1)[:, k - 1, None])
    else:
        row, col = (x.ravel() for x in np.indices(distance.shape))
    order = np.lexsort((target[col], distance[row, col], row))
    row, col = row[order], col[order]
    first = np.arange(len(row)) - np.searchsorted(row, row) < k
    row, col = row[first], col[first]
    return row, col, distance[row, col]


def _shape(rows: DataFrame, cols: Sequence[str], tasks: Sequence[Task], donors: bool) -> DataFrame:
    """Rows per task, with the columns the task does not know blanked out.

    Donors know the target and at least one column; receivers have the pattern of the task.
    """
    def one(task: Task) -> Column:
        known = [cols[i] for i in task.known]
        if donors:
            fits = F.col(cols[task.target]).isNotNull() & (F.coalesce(*known).isNotNull())
        else:
            fits = F.col("pattern") == task.pattern
        x = [F.col(c) if c in known else F.lit(None).cast("double") for c in cols]
        return F.when(fits, F.struct(
            F.lit(task.number).alias("task"), F.lit(len(known)).alias("n_known"),
            *[v.alias(f"x{i}") for i, v in enumerate(x)], F.col(cols[task.target]).alias("value"),
        ))

    each = rows.select("m", "rid", F.explode(F.array_compact(F.array(*[one(t) for t in tasks]))).alias("r"))
    return each.select("r.*", "m", "rid")


def _cell(p: int, cuts: Sequence[list[float]], per_task: int) -> Column:
    """Grid cell: the quantile interval of each known column, finer the fewer columns are known."""
    cell = F.lit(0).cast("long")
    for i in range(p):
        axis = F.when(F.col(f"x{i}").isNull(), -1)
        for n in range(1, p + 1):
            per_axis = max(2, int(per_task ** (1 / n)))
            step = max(1, (len(cuts[i]) + 1) // per_axis)
            axis = axis.when(F.col("n_known") == n, bucket_of(F.col(f"x{i}"), cuts[i][step - 1::step]))
        cell = cell * (len(cuts[i]) + 3) + axis + 1
    return cell


def _visits(receivers: DataFrame, p: int, boxes: pd.DataFrame, k: int) -> DataFrame:
    """Packed receivers per cell they have to visit."""
    low, high = ([f"{end}{i}" for i in range(p)] for end in ("lo", "hi"))
    sent = receivers.sparkSession.sparkContext.broadcast({
        task: (b["cell"].to_numpy(), b["m"].to_numpy(), b[low].to_numpy(dtype=float), b[high].to_numpy(dtype=float))
        for task, b in boxes.groupby("task")
    })
    names = [f"x{i}" for i in range(p)]

    def visited(block: np.ndarray, weight: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        near, far = _gaps(block, lo, hi, p)
        order = np.argsort(far, axis=1)
        enough = np.cumsum(weight[order], axis=1) >= k
        at = np.take_along_axis(order, enough.argmax(axis=1)[:, None], axis=1)
        bound = np.take_along_axis(far, at, axis=1) * (1 + 1e-9)
        return np.nonzero(near <= np.where(enough.any(axis=1)[:, None], bound, np.inf))

    def packed(task: int, ids: np.ndarray, rids: np.ndarray, values: np.ndarray, pairs: list) -> pd.DataFrame:
        """Receivers by cell, at most RECEIVERS of them in one row."""
        row, cell = (np.concatenate(x) for x in zip(*pairs, strict=True))
        by_cell = np.argsort(cell, kind="stable")
        row, cell = row[by_cell], cell[by_cell]
        starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        cuts = np.concatenate([np.arange(a, b, RECEIVERS) for a, b in zip(starts, np.r_[starts[1:], len(cell)], strict=True)])
        groups = np.split(row, cuts[1:])
        return pd.DataFrame({
            "task": task, "cell": ids[cell[cuts]], "rids": [rids[r] for r in groups],
            "receivers": [values[r].ravel() for r in groups],
        })

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for task, rows in batch.groupby("task"):
                if task not in sent.value:
                    continue
                ids, *boxes_of = sent.value[task]
                values, rids = rows[names].to_numpy(dtype=float), rows["rid"].to_numpy()
                pairs, held = [], 0
                for start in range(0, len(values), RECEIVERS):
                    row, cell = visited(values[start:start + RECEIVERS], *boxes_of)
                    pairs.append((row + start, cell))
                    held += len(row)
                    if held > 1_000_000:
                        yield packed(task, ids, rids, values, pairs)
                        pairs, held = [], 0
                if held:
                    yield packed(task, ids, rids, values, pairs)

    return receivers.select("task", "rid", *names).mapInPandas(
        run, "task int, cell long, rids array<long>, receivers array<double>"
    )


def _candidates(meeting: DataFrame, p: int, k: int) -> DataFrame:
    """The k nearest donors of each receiver within each block of donors."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: dict[str, list[np.ndarray]] = {n: [] for n in ("task", "rid", "distance", "value", "m")}
            for task, rids, packed, donors, values, counts in batch.itertuples(index=False):
                r = np.asarray(packed, dtype=float).reshape(-1, p)
                d = np.asarray(donors, dtype=float).reshape(-1, p)
                target = np.asarray(values, dtype=float)
                row, col, distance = _nearest(r, d, target, k, p)
                out["task"].append(np.full(len(row), task))
                out["rid"].append(np.asarray(rids)[row])
                out["distance"].append(distance)
                out["value"].append(target[col])
                out["m"].append(np.asarray(counts)[col])
            if out["task"]:
                yield pd.DataFrame({n: np.concatenate(parts) for n, parts in out.items()})

    columns = meeting.select("task", "rids", "receivers", "donors", "targets", "counts")
    return columns.mapInPandas(run, "task int, rid long, distance double, value double, m long")


def _weighted(candidates: DataFrame, k: int) -> DataFrame:
    """Mean of the k nearest values weighted by 1/distance; donors at distance zero win alone."""
    w = Window.partitionBy("task", "rid").orderBy("distance", "value")
    first = candidates.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= k)
    before = F.coalesce(F.sum("m").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    used = first.withColumn("take", F.greatest(F.least("m", F.lit(k) - before), F.lit(0))).filter("take > 0")
    zero = F.col("distance") == 0
    weight = F.col("take") / F.when(zero, F.lit(1.0)).otherwise(F.col("distance"))
    exact_value, exact_weight = (F.sum(F.when(zero, x)) for x in (F.col("take") * F.col("value"), F.col("take")))
    return used.groupBy("task", "rid").agg(
        F.coalesce(exact_value / exact_weight, F.sum(weight * F.col("value")) / F.sum(weight)).alias("filled")
    )


def _fills(
    rows: DataFrame, cols: Sequence[str], tasks: Sequence[Task], cuts: Sequence[list[float]], n: int, k: int, block: int
) -> DataFrame:
    """One row per incomplete tuple with the values found for its gaps."""
    p = len(cols)
    xs = [f"x{i}" for i in range(p)]
    donors = _shape(rows, cols, tasks, donors=True)
    donors = donors.groupBy("task", "n_known", *xs, "value").agg(F.sum("m").alias("m"))
    placed = donors.withColumn("cell", _cell(p, cuts, min(max(64, CELLS // len(tasks)), max(16, 2 * n // block))))
    placed = settle(placed.drop("n_known"), "donors")
    boxes = placed.groupBy("task", "cell").agg(
        F.count(F.lit(1)).alias("n"), F.sum("m").alias("m"),
        *[F.min(x).alias(f"lo{i}") for i, x in enumerate(xs)], *[F.max(x).alias(f"hi{i}") for i, x in enumerate(xs)],
    )
    splits = boxes.select("task", "cell", F.ceil(F.col("n") / block).alias("splits"))
    nan = F.lit(float("nan"))
    packed = (
        placed.join(splits, ["task", "cell"])
        .withColumn("part", F.pmod(F.xxhash64(*xs, "value"), F.col("splits")))
        .groupBy("task", "cell", "part")
        .agg(F.collect_list(F.struct(
            F.array(*[F.coalesce(x, nan) for x in xs]).alias("x"), F.col("value").alias("t"), F.col("m").alias("m"),
        )).alias("d"))
        .select(
            "task", "cell", F.flatten("d.x").alias("donors"), F.col("d.t").alias("targets"), F.col("d.m").alias("counts")
        )
    )
    receivers = _shape(rows.filter(F.col("pattern") != 0), cols, tasks, donors=False)
    visits = _visits(receivers, p, boxes.toPandas(), k)
    values = _weighted(_candidates(visits.join(packed, ["task", "cell"]), p, k), k)
    targets = F.create_map(*[F.lit(v) for t in tasks for v in (t.number, t.target)])
    wide = values.withColumn("at", F.try_element_at(targets, F.col("task"))).groupBy("rid").agg(
        *[F.max(F.when(F.col("at") == i, F.col("filled"))).alias(f"f_{c}") for i, c in enumerate(cols)]
    )
    return wide.join(rows.select("rid", *[F.col(c).alias(f"k_{c}") for c in cols]), "rid").drop("rid")


def _whole_rows(rows: DataFrame, cols: Sequence[str], n: int, k: int) -> DataFrame:
    """The values found for every gap, receivers against donors block by block: rid, target, filled.

    For wide tables with many patterns of gaps, where cells would have to be laid out per pattern. Blocks of receivers meet blocks
    of donors on a grid of tasks; products of the values and of the flags of what is known give all distances of a task at once, the
    nearest of each gap's donors are scored anew, and k of them per gap and task go on.
    """
    p = len(cols)
    packed_kind = "rids array<long>, x binary, m binary"

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for at in range(0, len(batch), PACK):
                part = batch.iloc[at:at + PACK]
                x = np.stack(part["x"].to_numpy()).astype(float)
                out.append((part["rid"].to_numpy(), x.tobytes(), part["m"].to_numpy(np.int64).tobytes()))
            yield pd.DataFrame(out, columns=["rids", "x", "m"])

    some = F.coalesce(*cols).isNotNull()
    gap = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    given = rows.filter(some).select("rid", "m", F.array(*cols).alias("x"), gap.alias("gap"))
    donors, receivers = (x.drop("gap").mapInPandas(packed, packed_kind) for x in (given, given.filter("gap")))
    down, across = -(-n // WIDE_RECEIVERS), -(-n // WIDE_DONORS)
    of = lambda c, parts: F.pmod(F.xxhash64(c), F.lit(parts)).cast("int")
    each = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    dealt = receivers.withColumn("side", F.lit(0)).withColumn("down", of("rids", down)).withColumn("across", each(across)).unionByName(
        donors.withColumn("side", F.lit(1)).withColumn("across", of("rids", across)).withColumn("down", each(down)))

    def meet(blocks: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list[np.ndarray]] = {c: [] for c in ("rid", "target", "distance", "value", "m")}
        left, right = blocks[blocks["side"] == 0], blocks[blocks["side"] == 1]
        if len(left) and len(right):
            r, d = (np.concatenate([np.frombuffer(b).reshape(-1, p) for b in side["x"]]) for side in (left, right))
            rids, counts = np.concatenate(left["rids"].to_numpy()), np.concatenate([np.frombuffer(b, np.int64) for b in right["m"]])
            there = ~np.isnan(d)
            flags, filled = there.astype(float), np.nan_to_num(d)
            squares = filled**2
            for at in range(0, len(r), 256):
                part = r[at:at + 256]
                known = ~np.isnan(part)
                own, zeros = known.astype(float), np.nan_to_num(part)
                shared = own @ flags.T
                ss = zeros**2 @ flags.T + own @ squares.T - 2 * (zeros @ filled.T)
                size = (zeros**2).sum(1)[:, None] + own @ squares.T
                with np.errstate(divide="ignore", invalid="ignore"):
                    rough, slack = ss * (p / shared), 64 * p * np.finfo(float).eps * size * (p / shared)
                for i in range(len(part)):
                    for j in np.flatnonzero(~known[i]):
                        fit = np.flatnonzero(there[:, j] & (shared[i] > 0))
                        if not len(fit):
                            continue
                        if len(fit) > k:
                            most = rough[i, fit] + slack[i, fit]
                            fit = fit[rough[i, fit] - slack[i, fit] <= np.partition(most, k - 1)[k - 1]]
                        both = known[i] & there[fit]
                        distance = np.sqrt((np.where(both, part[i] - d[fit], 0.0) ** 2).sum(1) * (p / both.sum(1)))
                        order = np.lexsort((d[fit, j], distance))[:k]
                        out["rid"].append(np.full(len(order), rids[at + i]))
                        out["target"].append(np.full(len(order), j))
                        out["distance"].append(distance[order])
                        out["value"].append(d[fit[order], j])
                        out["m"].append(counts[fit[order]])
        kinds = {"rid": np.int64, "target": np.int32, "distance": float, "value": float, "m": np.int64}
        return pd.DataFrame({c: np.concatenate([np.zeros(0, kinds[c]), *parts]) for c, parts in out.items()})

    found = dealt.groupBy("down", "across").applyInPandas(meet, "rid long, target int, distance double, value double, m long")
    return _weighted(found.withColumnRenamed("target", "task"), k)


def _impute_wide(typed: DataFrame, tuples: DataFrame, cols: Sequence[str], k: int) -> DataFrame:
    rows = settle(tuples.withColumn("rid", F.monotonically_increasing_id()), "tuples")

    def mean(c: str) -> Column:
        return F.try_divide(F.sum(F.col(c) * F.col("m")), F.sum(F.when(F.col(c).isNotNull(), F.col("m"))))

    facts = rows.agg(F.count(F.lit(1)).alias("n"), *[mean(c).alias(f"avg_{i}") for i, c in enumerate(cols)]).first()
    values = _whole_rows(rows, cols, max(facts["n"], 1), k).groupBy("rid").agg(
        F.map_from_entries(F.collect_list(F.struct("task", "filled"))).alias("f"))  # at most one entry per column
    wide = rows.select("rid", *[F.col(c).alias(f"k_{c}") for c in cols]).join(values, "rid").drop("rid")
    same = [F.col(c).eqNullSafe(F.col(f"k_{c}")) for c in cols]
    joined = typed.join(wide, same, "left")
    filled = {c: F.coalesce(F.col(c), F.try_element_at("f", F.lit(i)), F.lit(facts[f"avg_{i}"]).cast("double")) for i, c in enumerate(cols)}
    return joined.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in typed.columns])


def impute_knn(df: DataFrame, cols: Sequence[str], k: int = 5, block: int = 1024) -> DataFrame:
    """Fill the gaps of numeric columns from the k nearest rows that know the value.

    Of equally distant donors the smaller values come first. A gap without a usable donor takes the column
    mean. With few columns and patterns of gaps the donors of a pattern are laid out in cells; with more than MAX_COLUMNS columns or
    MAX_TASKS gaps of patterns all receivers meet all donors block by block. Both give the same values.
    """
    cols = list(cols)
    df = nan_to_null(df, cols)
    typed = df.withColumns({c: F.col(c).cast("double") for c in cols})
    tuples = typed.groupBy(*cols).agg(F.count(F.lit(1)).alias("m"))
    if len(cols) > MAX_COLUMNS:
        return _impute_wide(typed, tuples, cols, k)
    tuples = tuples.withColumn("pattern", _pattern(cols))
    rows = settle(tuples.withColumn("rid", F.monotonically_increasing_id()), "tuples")
    shares = [i / 256 for i in range(1, 256)]

    def mean(c: str) -> Column:
        return F.try_divide(F.sum(F.col(c) * F.col("m")), F.sum(F.when(F.col(c).isNotNull(), F.col("m"))))

    facts = rows.agg(
        F.collect_set("pattern").alias("patterns"), F.count(F.lit(1)).alias("n"),
        *[F.percentile_approx(c, shares, 10_000).alias(f"q_{c}") for c in cols],
        *[mean(c).alias(f"avg_{c}") for c in cols],
    ).first()
    cuts = [sorted(set(facts[f"q_{c}"] or [])) for c in cols]
    everything, p = (1 << len(cols)) - 1, range(len(cols))
    tasks = [
        Task(n, q, i, tuple(j for j in p if not q >> j & 1))
        for n, (q, i) in enumerate((q, i) for q in sorted(facts["patterns"]) if q not in (0, everything) for i in p if q >> i & 1)
    ]
    if len(tasks) > MAX_TASKS:
        return _impute_wide(typed, tuples, cols, k)
    gaps = typed.filter(_pattern(cols) != 0)
    if tasks:
        same = [F.col(c).eqNullSafe(F.col(f"k_{c}")) for c in cols]
        gaps = gaps.join(_fills(rows, cols, tasks, cuts, facts["n"], k, block), same, "left")
    else:
        gaps = gaps.withColumns({f"f_{c}": F.lit(None).cast("double") for c in cols})
    filled = gaps.withColumns({
        c: F.coalesce(F.col(c), F.col(f"f_{c}"), F.lit(facts[f"avg_{c}"])) for c in cols
    })
    return typed.filter(_pattern(cols) == 0).unionByName(filled.select(*typed.columns))
