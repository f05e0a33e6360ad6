"""Quality rules: plain limits, then robust multivariate outliers.

Every text gives a vector of transformed statistics: log length, log word length,
share of symbols, of repeated lines, of repeated passages and of letters and digits.  For
each language and source, the minimum-covariance-determinant estimate of centre
and scatter is found by concentration steps from three starts: the ``SUPPORT``
share of the rows nearest to the current estimate gives the next one, and the start
that ends with the smallest determinant is taken (ties: the first); a last,
reweighted estimate uses all rows that are not far.  Rows beyond a chi-squared
quantile of the Mahalanobis distance are rejected.

Rows never gather by group: each step is two aggregates (a quantile sketch and
sums of products) that combine in each task, so a source with a third of all rows
costs no more than its share.  Groups smaller than ``MIN_ROWS`` are estimated
together by language, small languages all together.  A small known spread for
each statistic is added to the scatter, so that a statistic that hardly varies
in a group rejects only what is far off by itself.

Cases: a null or empty text has no words and fails the plain limits; null
languages and sources are groups of their own; rows that repeat are judged each;
an empty table gives an empty result; further columns pass through.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockpilot.llm.text import SPACES, map_batches, on_workers, staged

# The plain limits of the contract.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20

SUPPORT = 0.75
STEPS = 4
MIN_ROWS = 60
#: Chance of rejecting a row of a normal group.
REJECT = 1e-5
FEATURES = ("length", "word_length", "symbols", "repeated_lines", "repeated_words", "alphanumeric")
#: Spread that is always granted to a statistic.
SPREAD = (1.0, 0.1, 0.1, 0.15, 0.15, 0.05)
N = len(FEATURES)

STATS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, n_lines bigint, n_alphanumeric bigint"
PARAMS = "level int, lang string, source string, start int, centre array<double>, inverse array<double>, logdet double"


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of five found twice or more."""
    windows = list(zip(*(words[i:] for i in range(WINDOW))))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, end = 0, 0
    for at, window in enumerate(windows):
        if counts[window] > 1:
            covered += at + WINDOW - max(at, end)
            end = at + WINDOW
    return covered


def text_stats(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    joined = b"".join(words).decode("utf-8", "surrogatepass")
    return (
        len(words),
        len(joined),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(joined) - sum(n for c, n in Counter(joined).items() if not c.isalnum()),
    )


def stats_column(text: Column) -> Column:
    names = [x.split()[0] for x in STATS.split(", ")]

    @F.pandas_udf(STATS)
    def stats(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([text_stats(t) for t in texts], columns=names)

    # Otherwise a filter on the statistics is moved below them, with a second call of
    # the function (and a second Python worker for each core) in the same stage.
    return stats.asNondeterministic()(text)


def base_failed(s: str = "stats") -> Column:
    n, repeated = F.col(f"{s}.n_words"), F.col(f"{s}.n_repeat_words")
    return (n < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * n)


def features(s: str = "stats") -> list[Column]:
    c = {x.split()[0]: F.col(f"{s}.{x.split()[0]}").cast("double") for x in STATS.split(", ")}
    words = F.greatest(c["n_words"], F.lit(1.0))
    return [
        F.log1p(c["n_words"]),
        F.log(F.greatest(c["word_chars"], F.lit(1.0)) / words),
        F.sqrt(c["n_symbols"] / words),
        F.sqrt(c["n_dup_lines"] / F.greatest(c["n_lines"], F.lit(1.0))),
        F.sqrt(c["n_repeat_words"] / words),
        c["n_alphanumeric"] / F.greatest(c["word_chars"], F.lit(1.0)),
    ]


def chi2_cdf(x: float, k: int) -> float:
    """Chi-squared distribution with an even number of degrees of freedom."""
    term = total = 1.0
    for i in range(1, k // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


def chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2_cdf(middle, k) < p else (low, middle)
    return high


def consistency(share: float) -> float:
    """What a scatter of the nearest ``share`` of normal rows falls short by."""
    return share / chi2_cdf(chi2_quantile(share, N), N + 2)


CELL = ["level", "lang", "source"]


def with_cells(rows: DataFrame) -> DataFrame:
    """Each row with the group that it is estimated in."""
    key = F.struct("lang", "source").alias("group")
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    small = F.sum(F.when(F.col("n") < MIN_ROWS, F.col("n")).otherwise(0))
    pooled = sizes.groupBy(F.col("group.lang").alias("of")).agg(small.alias("rest"))
    level = F.when(F.col("n") >= MIN_ROWS, 2).when(F.col("rest") >= MIN_ROWS, 1).otherwise(0)
    cells = staged(
        sizes.join(pooled, F.col("group.lang").eqNullSafe(F.col("of"))).select("group", level.alias("level")), "quality-groups"
    )
    placed = rows.withColumn("group", F.struct("lang", "source")).join(cells, "group")
    return placed.withColumn(
        "cell",
        F.struct(
            F.col("level"),
            F.when(F.col("level") > 0, F.col("lang")).alias("lang"),
            F.when(F.col("level") > 1, F.col("source")).alias("source"),
        ),
    ).drop("group", "level")


def _x(i: int) -> Column:
    return F.col(f"x{i}")


PAIRS = [(i, j) for i in range(N) for j in range(i, N)]


def starting_params(rows: DataFrame) -> DataFrame:
    """Three starts for each cell: medians with median deviations as a diagonal
    scatter; means with the covariance; medians with the covariance of what a
    hyperbolic tangent leaves of the standardised deviations, so that far rows count
    little but correlations are there from the start."""
    medians = staged(rows.groupBy("cell").agg(*[F.percentile_approx(_x(i), 0.5).alias(f"m{i}") for i in range(N)]), "quality-medians")
    off = rows.join(medians, "cell").groupBy("cell")
    spreads = off.agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(N)],
        *[F.percentile_approx(F.abs(_x(i) - F.col(f"m{i}")), 0.5).alias(f"s{i}") for i in range(N)],
    )
    widths = [F.sqrt(F.pow(1.4826 * F.col(f"s{i}"), 2) + SPREAD[i] ** 2).alias(f"w{i}") for i in range(N)]
    spreads = staged(spreads.select("cell", *[f"m{i}" for i in range(N)], *widths), "quality-spreads")
    z = [F.tanh((_x(i) - F.col(f"m{i}")) / F.col(f"w{i}")) for i in range(N)]
    sums = rows.join(spreads, "cell").groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(_x(i)) for i in range(N)]).alias("first"),
        F.array(*[F.sum(_x(i) * _x(j)) for i, j in PAIRS]).alias("second"),
        F.array(*[F.sum(z[i] * z[j]) for i, j in PAIRS]).alias("signs"),
        F.array(*[F.first(f"m{i}") for i in range(N)]).alias("medians"),
        F.array(*[F.first(f"w{i}") for i in range(N)]).alias("widths"),
    )

    def begin(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {c: [] for c in (*CELL, "start", "centre", "inverse", "logdet")}
        cells = [batch.column(c).to_pylist() for c in CELL]
        for cell, n, first, second, signs, medians, widths in zip(
            zip(*cells), *(batch.column(c).to_pylist() for c in ("n", "first", "second", "signs", "medians", "widths"))
        ):
            centre, width = np.array(first) / n, np.array(widths)
            starts = (
                (np.array(medians), np.diag(np.square(width))),
                (centre, _symmetric(second) / n - np.outer(centre, centre) + np.diag(np.square(SPREAD))),
                (np.array(medians), (_symmetric(signs) / n + 1e-3 * np.eye(N)) * np.outer(width, width)),
            )
            for k, (middle, scatter) in enumerate(starts):
                for c, v in zip(out, (*cell, k, middle.tolist(), np.linalg.inv(scatter).ravel().tolist(), float(np.linalg.slogdet(scatter)[1]))):
                    out[c].append(v)
        return out

    return _as_params(map_batches(sums.select("cell.*", *[c for c in sums.columns if c != "cell"]), begin, PARAMS))


def _symmetric(upper: list[float]) -> np.ndarray:
    matrix = np.zeros((N, N))
    for (i, j), v in zip(PAIRS, upper):
        matrix[i, j] = matrix[j, i] = v
    return matrix


def _as_params(solved: DataFrame) -> DataFrame:
    return solved.select(F.struct(*CELL).alias("cell"), "start", "centre", "inverse", "logdet")


def distance() -> Column:
    """Squared Mahalanobis distance."""
    d = [_x(i) - F.get("centre", F.lit(i)) for i in range(N)]
    return sum((F.get("inverse", F.lit(i * N + j)) * d[i] * d[j] * (1 if i == j else 2) for i, j in PAIRS), F.lit(0.0))


def estimated(rows: DataFrame, factor: float) -> DataFrame:
    """cell, start, centre, inverse and log of the determinant of the scatter, from
    sums of products of the rows."""
    sums = rows.groupBy("cell", "start").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(_x(i)) for i in range(N)]).alias("first"),
        F.array(*[F.sum(_x(i) * _x(j)) for i, j in PAIRS]).alias("second"),
    )

    def solve(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"centre": [], "inverse": [], "logdet": []}
        for n, first, second in zip(*(batch.column(c).to_pylist() for c in ("n", "first", "second"))):
            centre = np.array(first) / n
            scatter = factor * (_symmetric(second) / n - np.outer(centre, centre)) + np.diag(np.square(SPREAD))
            out["centre"].append(centre.tolist())
            out["inverse"].append(np.linalg.inv(scatter).ravel().tolist())
            out["logdet"].append(float(np.linalg.slogdet(scatter)[1]))
        return {c: batch.column(c) for c in (*CELL, "start")} | out

    return _as_params(map_batches(sums.select("cell.*", "start", "n", "first", "second"), solve, PARAMS))


FITTED = ("start", "centre", "inverse", "logdet")


def robust_params(rows: DataFrame) -> DataFrame:
    """The reweighted minimum-covariance-determinant estimate of each cell: of all
    starts, the one whose nearest rows have the smallest determinant in the end.
    rows: cell, x0, x1, ..."""
    params = staged(starting_params(rows), "quality-start")
    for _ in range(STEPS):
        near = rows.join(params, "cell").withColumn("d2", distance()).drop("centre", "inverse", "logdet")
        limits = staged(near.groupBy("cell", "start").agg(F.percentile_approx("d2", SUPPORT).alias("limit")), "quality-limits")
        nearest = near.join(limits, ["cell", "start"]).where("d2 <= limit")
        params = staged(estimated(nearest, consistency(SUPPORT)), "quality-step")
    chosen = params.groupBy("cell").agg(F.min_by(F.struct(*FITTED), F.struct("logdet", "start")).alias("best")).select("cell", "best.*")
    far = chi2_quantile(0.975, N)
    clean = rows.join(chosen, "cell").withColumn("d2", distance()).where(F.col("d2") <= far).drop("centre", "inverse", "logdet")
    return staged(estimated(clean, consistency(0.975)).drop("start", "logdet"), "quality-params")


def _with_features(stats: DataFrame) -> DataFrame:
    return stats.withColumn("base_failed", base_failed()).withColumns({f"x{i}": x for i, x in enumerate(features())})


def quality_rules(docs: DataFrame, columns: list[str] | None = None, reject: float = REJECT) -> DataFrame:
    """row (the input's columns, or ``columns``), stats, base_failed, distance, kept."""
    on_workers(docs.sparkSession)
    group = {c: F.col(c).cast("string") if c in docs.columns else F.lit(None).cast("string") for c in ("lang", "source")}
    row = F.struct(*[F.col(f"`{c}`") for c in columns or docs.columns]).alias("row")
    read = docs.select(row, *[v.alias(c) for c, v in group.items()], stats_column(F.col("text").cast("string")).alias("stats"))
    # Whole rows are not staged: their statistics are taken a second time, which costs
    # less than another copy of all texts.
    stats = staged(read if columns else read.drop("row"), "quality-stats")
    with_x = _with_features(stats)
    sound = with_x.where("not base_failed").select("lang", "source", *[f"x{i}" for i in range(N)])
    rows = staged(with_cells(sound).select("cell", *[f"x{i}" for i in range(N)]), "quality-vectors")
    params = robust_params(rows)
    # Every group of a sound row has parameters; a row that fails the plain limits needs none.
    groups = staged(with_cells(sound).select("lang", "source", "cell").distinct().join(params, "cell"), "quality-by-group")
    key = F.struct("lang", "source")
    judged = (with_x if columns else _with_features(read)).withColumn("group", key).join(groups.select(key.alias("group"), "centre", "inverse"), "group", "left")
    limit = chi2_quantile(1 - reject, N)
    return judged.withColumn("distance", distance()).select(
        "row", "stats", "base_failed", "distance", (~F.col("base_failed") & F.coalesce(F.col("distance") <= limit, F.lit(True))).alias("kept")
    )


def keep_good(docs: DataFrame, reject: float = REJECT) -> DataFrame:
    """The documents that pass."""
    return quality_rules(docs, reject=reject).where("kept").select("row.*")
