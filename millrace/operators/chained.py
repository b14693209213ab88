"""Chained-equation imputation of tables of any width.

Each round regresses every incomplete column on the others and replaces its gaps by the prediction. All
models are linear, so after any number of rounds a filled value is a linear function of the known values
of its row, with coefficients that depend only on *which* columns are missing. Where few patterns of gaps occur it is therefore
enough to know, per pattern, the row count, sums and cross products of the known columns: one pass, whose partial matrices
are added up in a tree. The rounds work on these small matrices, and the outcome is a table of coefficients per pattern.
Where patterns are many (random gaps in many columns) the rounds work on the rows: the completed rows are a stored state, each
regression is one pass that sums cross products, and a round's regressions are applied to the state when it is stored anew.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.missing import nan_to_null
from millrace.session import settle

#: Bytes of cross products per pattern that the driver may hold; beyond, the rounds work on the rows.
MOMENT_BYTES = 64 * 1024 * 1024
#: Partial matrices that are added up at a time.
FAN = 32


def _pattern(cols: Sequence[str]) -> Column:
    """The pattern of gaps as a text, one sign per column."""
    return F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in cols])


def _bits(pattern: str) -> int:
    return int(pattern[::-1], 2)


def _rows(batch: pd.DataFrame, p: int) -> np.ndarray:
    """The values of a batch as a matrix, gaps as NaN."""
    return np.stack(batch["x"].to_numpy()).astype(float) if len(batch) else np.zeros((0, p))


def _sums(rows: DataFrame, matrices: Callable[[pd.DataFrame], Iterator[tuple[str, np.ndarray]]]) -> dict[str, np.ndarray]:
    """Sum of the matrices that ``matrices`` makes of each batch, by name: first per partition, then in a tree."""
    def added(parts: Iterator[tuple[str, np.ndarray]]) -> pd.DataFrame:
        held: dict[str, np.ndarray] = {}
        for name, one in parts:
            held[name] = held[name] + one if name in held else one
        at = TaskContext.get().partitionId()
        return pd.DataFrame([(n, at, m.tobytes()) for n, m in held.items()], columns=["name", "at", "matrix"])

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield added(x for batch in batches for x in matrices(batch))

    def again(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield added((n, np.frombuffer(m)) for batch in batches for n, m in zip(batch["name"], batch["matrix"], strict=True))

    kind = "name string, at int, matrix binary"
    parts, left = rows.mapInPandas(first, kind), rows.rdd.getNumPartitions()
    while left > FAN:
        left = -(-left // FAN)
        parts = parts.repartition(left, F.pmod(F.col("at"), F.lit(left))).mapInPandas(again, kind)
    out: dict[str, np.ndarray] = {}
    for r in parts.collect():
        one = np.frombuffer(r["matrix"])
        out[r["name"]] = out[r["name"]] + one if r["name"] in out else one
    side = {n: int(np.sqrt(len(m))) for n, m in out.items()}
    return {n: m.reshape(side[n], side[n]) for n, m in out.items()}


def pattern_moments(df: DataFrame, cols: Sequence[str], shift: np.ndarray) -> dict[int, np.ndarray]:
    """Matrix of sums of products of (1, x1, …, xp) per pattern; unknown values count as 0.

    Columns are shifted by a value near their mean, which keeps the sums well conditioned.
    """
    p = len(cols)

    def matrices(batch: pd.DataFrame) -> Iterator[tuple[str, np.ndarray]]:
        for pattern, part in batch.groupby("pattern"):
            z = np.c_[np.ones(len(part)), np.nan_to_num(_rows(part, p) - shift)]
            yield pattern, (z.T @ z).ravel()

    rows = df.select(_pattern(cols).alias("pattern"), F.array(*[F.col(c).cast("double") for c in cols]).alias("x"))
    return {_bits(pattern): m for pattern, m in _sums(rows, matrices).items()}


def evidence_ridge(gram: np.ndarray, xy: np.ndarray, yy: float, n: float, rounds: int = 300) -> np.ndarray:
    """Ridge weights for centred data, the penalty chosen by maximum evidence (Bayesian ridge)."""
    tiny = 1e-6
    values, vectors = np.linalg.eigh(gram)
    values = np.clip(values, 0.0, None)
    rotated = vectors.T @ xy
    noise = 1.0 / max(yy / n, np.finfo(float).eps)
    penalty = 1.0
    weights = np.zeros(len(xy))
    for _ in range(rounds):
        new = vectors @ (rotated / (values + penalty / noise))
        residual = max(yy - 2 * new @ xy + new @ gram @ new, 0.0)
        used = np.sum(noise * values / (penalty + noise * values))
        penalty = (used + 2 * tiny) / (new @ new + 2 * tiny)
        noise = (n - used + 2 * tiny) / (residual + 2 * tiny)
        done = np.sum(np.abs(new - weights)) < 1e-3
        weights = new
        if done:
            break
    return vectors @ (rotated / (values + penalty / noise))


def chained_maps(
    moments: dict[int, np.ndarray], p: int, max_rounds: int, tol: float
) -> dict[int, np.ndarray]:
    """Per pattern a matrix that turns (1, known values, 0 for gaps) into the completed row."""
    total = sum(moments.values())
    missing = [[bool(q >> i & 1) for i in range(p)] for q in moments]
    known_n = np.array([
        sum(m[0, 0] for q, m in moments.items() if not q >> i & 1) for i in range(p)
    ])
    means = np.divide(total[0, 1:], known_n, out=np.zeros(p), where=known_n > 0)
    maps = {}
    for q in moments:
        a = np.eye(p + 1)
        for i in range(p):
            if q >> i & 1:
                a[i + 1] = 0.0
                a[i + 1, 0] = means[i]
        maps[q] = a
    gaps = [total[0, 0] - known_n[i] for i in range(p)]
    visit = [i for i in sorted(range(p), key=lambda i: (gaps[i], i)) if gaps[i] > 0 and known_n[i] > 0]
    if p < 2 or not any(any(row) for row in missing):
        return maps
    scale = np.sqrt(max(np.max(np.diag(total)[1:] / np.maximum(known_n, 1)), np.finfo(float).tiny))
    for _ in range(max_rounds):
        before = {q: a.copy() for q, a in maps.items()}
        for i in visit:
            others = [j + 1 for j in range(p) if j != i]
            s = sum(
                maps[q] @ m @ maps[q].T for q, m in moments.items() if not q >> i & 1
            )
            n = s[0, 0]
            mean = s[0] / n
            centred = s - n * np.outer(mean, mean)
            w = evidence_ridge(
                centred[np.ix_(others, others)], centred[others, i + 1], centred[i + 1, i + 1], n
            )
            intercept = mean[i + 1] - w @ mean[others]
            for q in moments:
                if q >> i & 1:
                    line = w @ maps[q][others]
                    line[0] += intercept
                    maps[q][i + 1] = line
        moved = 0.0
        for q, m in moments.items():
            d = maps[q] - before[q]
            moved += float(np.trace(d @ m @ d.T))
        filled = sum(m[0, 0] * bin(q).count("1") for q, m in moments.items())
        if np.sqrt(max(moved, 0.0) / max(filled, 1.0)) < tol * scale:
            break
    return maps


def _by_pattern(df: DataFrame, cols: Sequence[str], shift: np.ndarray, maps: dict[int, np.ndarray]) -> DataFrame:
    """Fill the gaps by the coefficients of each row's pattern."""
    sent = df.sparkSession.sparkContext.broadcast(maps)  # at most MOMENT_BYTES

    @F.pandas_udf("array<double>")
    def completed(patterns: pd.Series, values: pd.Series) -> pd.Series:
        out = np.stack(values.to_numpy()).astype(float) if len(values) else np.zeros((0, len(cols)))
        for pattern, at in patterns.groupby(patterns).indices.items():
            line = sent.value[_bits(pattern)]
            known = np.nan_to_num(out[at] - shift)
            out[at] = np.where(np.isnan(out[at]), line[1:, 0] + known @ line[1:, 1:].T + shift, out[at])
        return pd.Series(list(out))

    values = F.array(*[F.col(c).cast("double") for c in cols])
    done = df.withColumn("__x", completed(_pattern(cols), values))
    return _unpacked(done, cols)


def _unpacked(done: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Known values as they were; a value of NaN (nothing was known of the column) stays a gap."""
    filled = {c: F.get("__x", F.lit(i)) for i, c in enumerate(cols)}
    return done.withColumns({c: F.coalesce(F.col(c).cast("double"), F.when(~F.isnan(v), v)) for c, v in filled.items()}).drop("__x")


Step = tuple[int, np.ndarray, float]


def _applied(z: np.ndarray, gap: np.ndarray, steps: Sequence[Step]) -> np.ndarray:
    """Completed rows after some regressions (column, weights of the others, intercept)."""
    z = z.copy()
    for i, weights, intercept in steps:
        at = gap[:, i]
        z[at, i] = z[at] @ weights + intercept  # the column's own weight is 0
    return z


def _rounds_on_rows(df: DataFrame, cols: Sequence[str], shift: np.ndarray, known_n: np.ndarray, max_rounds: int, tol: float) -> DataFrame:
    """The same rounds on a stored state of completed rows."""
    p = len(cols)
    kept = settle(df.withColumn("__row", F.monotonically_increasing_id()), "rows")
    total = kept.count()
    gaps = total - known_n
    visit = [i for i in sorted(range(p), key=lambda i: (gaps[i], i)) if gaps[i] > 0 and known_n[i] > 0]
    given = kept.select("__row", F.array(*[F.col(c).cast("double") for c in cols]).alias("x"))
    kind = "__row long, z binary, gap binary, moved double, size double"

    def start(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _rows(batch, p)
            z = np.nan_to_num(x - shift)  # a gap starts at the mean
            yield pd.DataFrame({"__row": batch["__row"], "z": [r.tobytes() for r in z], "gap": [g.tobytes() for g in np.isnan(x)],
                                "moved": 0.0, "size": (z**2).max(axis=1, initial=0.0)})

    def held(batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        z = np.stack([np.frombuffer(b) for b in batch["z"]]) if len(batch) else np.zeros((0, p))
        gap = np.stack([np.frombuffer(b, bool) for b in batch["gap"]]) if len(batch) else np.zeros((0, p), bool)
        return z, gap

    state = settle(given.mapInPandas(start, kind), "state")
    scale = None
    for _ in range(max_rounds):
        steps: list[Step] = []
        for i in visit:
            def gram(batch: pd.DataFrame, i: int = i, steps: tuple = tuple(steps)) -> Iterator[tuple[str, np.ndarray]]:
                z, gap = held(batch)
                one = np.c_[np.ones(len(z)), _applied(z, gap, steps)][~gap[:, i]]
                yield "all", (one.T @ one).ravel()

            s = _sums(state.select("z", "gap"), gram)["all"]
            n, others = s[0, 0], [j + 1 for j in range(p) if j != i]
            mean = s[0] / n
            centred = s - n * np.outer(mean, mean)
            w = evidence_ridge(centred[np.ix_(others, others)], centred[others, i + 1], centred[i + 1, i + 1], n)
            weights = np.insert(w, i, 0.0)
            steps.append((i, weights, float(mean[i + 1] - w @ mean[others])))
            if scale is None:
                scale = np.sqrt(max(np.max(np.diag(s)[1:]) / n, np.finfo(float).tiny))

        def store(batches: Iterator[pd.DataFrame], steps: tuple = tuple(steps)) -> Iterator[pd.DataFrame]:
            for batch in batches:
                z, gap = held(batch)
                now = _applied(z, gap, steps)
                yield pd.DataFrame({"__row": batch["__row"], "z": [r.tobytes() for r in now], "gap": batch["gap"],
                                    "moved": ((now - z) ** 2).sum(axis=1), "size": batch["size"]})

        state = settle(state.mapInPandas(store, kind), "state")
        moved = state.agg(F.sum("moved")).first()[0] or 0.0
        if not visit or np.sqrt(moved / max(float(gaps.sum()), 1.0)) < tol * scale:
            break
    unknown = np.where(known_n > 0, 0.0, np.nan)

    @F.pandas_udf("array<double>")
    def shown(states: pd.Series) -> pd.Series:
        return pd.Series([np.frombuffer(z) + shift + unknown for z in states], dtype=object)

    done = kept.join(state.select("__row", shown("z").alias("__x")), "__row", "left").drop("__row")
    return _unpacked(done, cols)


def impute_iterative(
    df: DataFrame, cols: Sequence[str], max_rounds: int = 20, tol: float = 1e-3, moment_bytes: int = MOMENT_BYTES
) -> DataFrame:
    """Fill the gaps of numeric columns by chained regressions.

    Columns are visited by ascending number of gaps, starting from their means. Rounds stop when the filled
    values move by less than ``tol`` of the column scale on average. NaN is a gap; a column without any value stays empty. Any number of
    columns: with few patterns of gaps one pass is enough, otherwise each regression is a pass over the stored rows. Only
    matrices of the size of the columns reach the driver, at most ``moment_bytes`` of them.
    """
    cols = list(cols)
    df = nan_to_null(df, cols)
    first = df.agg(*[F.avg(c).alias(f"a{i}") for i, c in enumerate(cols)], *[F.count(c).alias(f"n{i}") for i, c in enumerate(cols)],
                   F.approx_count_distinct(_pattern(cols)).alias("patterns")).first()
    p = len(cols)
    shift = np.array([first[f"a{i}"] if first[f"a{i}"] is not None else 0.0 for i in range(p)], dtype=float)
    known_n = np.array([first[f"n{i}"] for i in range(p)], dtype=float)
    if 1.2 * first["patterns"] * (p + 1) ** 2 * 8 > moment_bytes:
        return _rounds_on_rows(df, cols, shift, known_n, max_rounds, tol)
    maps = chained_maps(pattern_moments(df, cols, shift), p, max_rounds, tol)
    for q, a in maps.items():
        for i in range(p):
            if q >> i & 1 and not known_n[i]:
                a[i + 1] = np.nan
    return _by_pattern(df, cols, shift, maps)
