"""Exact quantiles whose memory and task size do not grow with the largest group.

``percentile`` keeps every distinct value of a group in one hash map. Here the
distinct (key, value) pairs are counted first, cut into value cells at sketch
quantiles of all pairs, and only the cells holding a wanted rank are ordered.
The number of cells follows the number of pairs, so a cell holds about
``CELL_PAIRS`` of them at most, whatever the table's size and key distribution.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medalyst.operators.ordered import _join_on
from medalyst.session import durable


LEAST_CELLS = 256
CELL_PAIRS = 1_000_000


def cell_edges(df: DataFrame, values: Sequence[str], cells: int) -> list[list[float]]:
    """At most ``cells - 1`` inner cut points per column from the built-in sketch, in one pass."""
    probs = [i / cells for i in range(1, cells)]
    return [sorted(set(cuts)) for cuts in df.select(*values).approxQuantile(list(values), probs, 0.25 / cells)]


def into_cells(df: DataFrame, value: str, edges: Sequence[float], out: str) -> DataFrame:
    """Cell number by binary search over ``edges``."""
    if not edges:
        return df.withColumn(out, F.lit(0))
    splits = [float("-inf"), *edges, float("inf")]
    found = Bucketizer(splits=splits, inputCol=value, outputCol=out, handleInvalid="keep").transform(df)
    return found.withColumn(out, F.col(out).cast("int"))


def order_statistics(counted: DataFrame, ranks: Mapping[str, Column], keys: Sequence[str] = (), cells: int | None = None) -> DataFrame:
    """What stands at given ranks of each key, from the counted values ``keys, _x, _n`` (a durable table).

    ``ranks`` maps an output column to a rank from 0 over ``_total``, the rows of the key. The output is a struct of the value ``x``, how many
    rows stand ``before`` that value and how many have it (``n``); ``_total`` comes with it.
    """
    coded = counted.withColumn("_v", F.col("_x").cast("double"))
    cells = cells or max(LEAST_CELLS, -(-counted.count() // CELL_PAIRS))
    placed = into_cells(coded, "_v", cell_edges(coded, ["_v"], cells)[0], "_cell")

    # at most ``cells`` rows per key from here to the filter
    upto = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*keys)
    sizes = (placed.groupBy(*keys, "_cell").agg(F.sum("_n").alias("_cn"))
             .withColumns({"_hi": F.sum("_cn").over(upto), "_total": F.sum("_cn").over(whole)})
             .withColumn("_lo", F.col("_hi") - F.col("_cn")))
    wanted = F.lit(False)
    for rank in ranks.values():
        wanted = wanted | ((rank >= F.col("_lo")) & (rank < F.col("_hi")))
    targets = sizes.where(wanted).select(*keys, "_cell", "_lo", "_total")

    in_cell = (Window.partitionBy(*keys, "_cell").orderBy("_x")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = (_join_on(placed, targets, [*keys, "_cell"])
              .withColumn("_end", F.col("_lo") + F.sum("_n").over(in_cell))
              .withColumn("_start", F.col("_end") - F.col("_n")))
    here = F.struct(F.col("_x").alias("x"), F.col("_start").alias("before"), F.col("_n").alias("n"))
    at = lambda rank: F.max(F.when((rank >= F.col("_start")) & (rank < F.col("_end")), here))
    return ranked.groupBy(*keys).agg(F.max("_total").alias("_total"), *[at(rank).alias(name) for name, rank in ranks.items()])


def exact_quantiles(df: DataFrame, value: str | Column, probs: Mapping[str, float], keys: Sequence[str] = (),
                    cells: int | None = None) -> DataFrame:
    """Linear-interpolation quantiles, one row per key; NULL values are ignored.

    ``probs`` maps output columns to probabilities.
    """
    x = F.col(value) if isinstance(value, str) else value
    # read three times below, so written once: the input is scanned and shuffled a single time
    counted = durable(df.select(*keys, x.cast("double").alias("_x")).where("_x is not null")
                      .groupBy(*keys, "_x").agg(F.count(F.lit(1)).alias("_n")))
    position = {name: F.lit(float(p)) * (F.col("_total") - 1) for name, p in probs.items()}
    ranks = {f"_{name}_{side}": edge(pos) for name, pos in position.items() for side, edge in (("l", F.floor), ("h", F.ceil))}
    picked = order_statistics(counted, ranks, keys, cells)
    share = {name: pos - F.floor(pos) for name, pos in position.items()}
    low, high = (lambda n: F.col(f"_{n}_l.x")), (lambda n: F.col(f"_{n}_h.x"))
    return picked.select(*keys, *[(low(n) + (high(n) - low(n)) * share[n]).alias(n) for n in probs])


def quantile_struct(df: DataFrame, value: str | Column, probs: Mapping[str, float]) -> Column:
    """The table's quantiles as a one-row scalar subquery; use ``col["name"]``."""
    return exact_quantiles(df, value, probs).select(F.struct(*probs).alias("q")).scalar()


def with_value_bins(df: DataFrame, value: str, bins: int, labels: Sequence, out: str) -> DataFrame:
    """Equal-share bins by value: right-closed, lowest edge included, equal values together.

    Repeated edges merge their bins (the higher label is never used).
    """
    probs = {f"e{i}": i / bins for i in range(1, bins)}
    q = quantile_struct(df, value, probs)
    expr = F.when(F.col(value) <= q["e1"], F.lit(labels[0]))
    for i in range(2, bins):
        expr = expr.when(F.col(value) <= q[f"e{i}"], F.lit(labels[i - 1]))
    return df.withColumn(out, F.when(F.col(value).isNotNull(), expr.otherwise(F.lit(labels[-1]))))


def within_fences(df: DataFrame, value: str, reach: float = 1.5) -> DataFrame:
    """Rows inside the quartile fences; NULLs drop out."""
    q = quantile_struct(df, value, {"q1": 0.25, "q3": 0.75})
    margin = (q["q3"] - q["q1"]) * F.lit(reach)
    return df.where(F.col(value).between(q["q1"] - margin, q["q3"] + margin))


def with_rank_bins(df: DataFrame, value: str, tiebreak: Sequence[str], bins: int, out: str) -> DataFrame:
    """Equal-share bins by row rank (ties split by ``tiebreak``), numbered from 1.

    Rows without a value get no bin.
    """
    return with_all_rank_bins(df, {out: value}, tiebreak, bins)


def with_all_rank_bins(df: DataFrame, values: Mapping[str, str], tiebreak: Sequence[str], bins: int) -> DataFrame:
    """``with_rank_bins`` for several columns (output to value column) at once.

    A bin's last row is found by counting values, without ordering the table: the counts give the value that stands there, and only where its equal
    values go on into the next bin are these rows ordered by ``tiebreak``. The rows themselves are read in place and compared with those few bounds.
    """
    from medalyst.operators.ordered import number_rows

    bounds: dict[tuple[str, int], list] = {}
    kinds: dict[str, list[str]] = {}
    for out, value in values.items():
        kinds.setdefault(df.schema[value].dataType.simpleString(), []).append(out)
    for outs in kinds.values():                     # columns of one type share a pass
        long = df.select(F.explode(F.array(*[F.struct(F.lit(out).alias("_out"), F.col(values[out]).alias("_x")) for out in outs])).alias("p")).select("p.*")
        counted = durable(long.where(F.col("_x").isNotNull()).groupBy("_out", "_x").agg(F.count(F.lit(1)).alias("_n")))
        ranks = {f"r{i}": F.floor((F.col("_total") - 1) * i / bins) for i in range(1, bins)}
        for row in order_statistics(counted, ranks, ["_out"]).select("_out", *[F.col(f"r{i}").alias(f"s{i}") for i in range(1, bins)], *[rank.alias(name) for name, rank in ranks.items()]).collect():     # a row for each column
            for i in range(1, bins):
                held = row[f"s{i}"]
                bounds[row["_out"], i] = [held["x"], row[f"r{i}"] - held["before"], held["n"]]
    split = {k: b for k, b in bounds.items() if b[1] + 1 < b[2]}        # equal values on both sides of the bound
    if split:
        cuts = F.array(*[F.struct(F.lit(out).alias("_out"), F.lit(i).alias("_i"), (F.col(values[out]) == F.lit(x)).alias("_tie"), F.lit(offset + 1).cast("bigint").alias("_at"))
                         for (out, i), (x, offset, _) in split.items()])
        ties = df.select(*tiebreak, F.explode(F.filter(cuts, lambda c: c["_tie"])).alias("c")).select(*tiebreak, "c._out", "c._i", "c._at")
        last = number_rows(ties, tiebreak, ["_out", "_i"], out="_rn").where("_rn = _at")
        for row in last.select("_out", "_i", *tiebreak).collect():       # one row a bound
            bounds[row["_out"], row["_i"]].append([row[c] for c in tiebreak])
    typed = lambda c, v: F.lit(v).cast(df.schema[c].dataType)
    made = {}
    for out, value in values.items():
        number = F.lit(1)
        for i in range(1, bins):
            if (out, i) in bounds:
                x, _, _, *tie = bounds[out, i]
                after = F.col(value) > typed(value, x)
                if tie:
                    beyond = F.struct(*tiebreak) > F.struct(*[typed(c, v).alias(c) for c, v in zip(tiebreak, tie[0])])
                    after = after | ((F.col(value) == typed(value, x)) & beyond)
                number = number + after.cast("int")
        made[out] = F.when(F.col(value).isNotNull(), number)
    return df.withColumns(made)
