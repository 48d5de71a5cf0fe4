"""Ordered-per-key calculations that survive a key holding much of the table.

A window function sorts all rows of a key inside one task. That is fine until one
key holds a third of a huge table. ``KeySequence`` keeps the plain window while
the whole input is small enough for any one task. Beyond that, it cuts the rows
of every key above ``rows_per_task`` into slices, as a sample sort does: splitters
are drawn from a sample of the whole order, all order columns and NULLs included, with a
digest of the row behind them for ties. It runs the window per slice, and
carries counts, sums and edge rows between slices in a table with one row per
slice. Slices are a monotone function of the order, so results equal those of
the plain window. Rows of all other keys are neither placed nor stored; hot rows,
splitters and the carried table are written to the shared folder: later steps
read them instead of computing the input again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.sizing import estimated_bytes, small_side, stored

PLAIN_BYTES = 256 * 1024 * 1024
ROWS_PER_TASK = 20_000_000
# rows sampled for each slice: its size is off by about one part in the root of this
FAN = 64

_TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def ascending(df: DataFrame, order: Sequence[str]) -> list[Column]:
    """Order terms as ascending expressions; ``-name`` reverses one. NULLs come first."""
    terms = []
    for name in order:
        if not name.startswith("-"):
            terms.append(F.col(name))
            continue
        kind = df.schema[name[1:]].dataType
        if isinstance(kind, T.NumericType):
            terms.append(-F.col(name[1:]))
        elif isinstance(kind, _TIMES):
            terms.append(-F.unix_micros(F.col(name[1:]).cast("timestamp")))
        else:
            raise TypeError(f"cannot reverse the order of {name[1:]}: {kind.simpleString()}")
    return terms


def _same_key(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[f"_r_{name}"])
    return condition


def _prefixed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({name: f"_r_{name}" for name in names})


class KeySequence:
    """Rows of each key of ``df`` in one total order.

    ``like`` reuses the splitters of another sequence with the same keys and
    order, for a subset of its rows.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        plain_bytes: int = PLAIN_BYTES,
        rows_per_task: int = ROWS_PER_TASK,
        fan: int = FAN,
        like: KeySequence | None = None,
    ):
        self.df = df
        self.keys = list(keys)
        self.order = list(order)
        self.rows_per_task = rows_per_task
        self.fan = fan
        self.cuts: DataFrame | None = None
        if like is not None:
            self.cuts = like.cuts
        elif estimated_bytes(df) > plain_bytes:
            self.cuts = self._cut_points()
        self.pieces = self._placed() if self.sliced else None

    @property
    def sliced(self) -> bool:
        return self.cuts is not None

    def _whole_order(self) -> list[Column]:
        """The order terms, and a digest of the row that sets apart what they leave equal."""
        terms = [term.alias(f"t{i}") for i, term in enumerate(ascending(self.df, self.order))]
        return [*terms, F.xxhash64(*[F.col(f"`{c}`") for c in self.df.columns]).alias("tie")]

    def _cut_points(self) -> DataFrame | None:
        """The splitters of each key that has too many rows for one task; None if there is no such key.

        There are at most rows / rows_per_task such keys, and as many splitters in all.
        """
        sizes = self.df.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > self.rows_per_task)
        hot = stored(_prefixed(sizes, self.keys), "hot-keys")
        if hot.isEmpty():
            return None
        rows = self.df.where(F.rand(17) < F.lit(self.fan / self.rows_per_task))
        rows = rows.select(*self.keys, F.struct(*self._whole_order()).alias("_p"))
        rows = rows.join(small_side(hot), _same_key(rows, hot, self.keys), "inner")
        named = [f"_r_{k}" for k in self.keys]
        sampled = rows.groupBy(*named, "_n").agg(F.sort_array(F.collect_list("_p")).alias("_sample"))
        step = F.greatest(F.lit(1), F.round(F.lit(float(self.rows_per_task)) * F.size("_sample") / F.col("_n"))).cast("int")
        cuts = sampled.select(*named, F.array_distinct(F.filter("_sample", lambda _, i: (i + 1) % step == 0)).alias("_cuts"))
        # a lookup first finds a block of cuts, then the place inside the block
        block = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size("_cuts")))).cast("int")
        ends = F.filter("_cuts", lambda _, i: i % F.col("_block") == F.col("_block") - 1)
        return stored(cuts.withColumn("_block", block).withColumn("_ends", ends), "cuts")

    def _placed(self) -> DataFrame:
        """Rows of the keys that are cut, with the number of their slice."""
        placed = self.df.withColumn("_p", F.struct(*self._whole_order()))
        placed = placed.join(small_side(self.cuts), _same_key(placed, self.cuts, self.keys), "inner")

        def below(points):
            return F.size(F.filter(points, lambda point: point < F.col("_p")))

        blocks = below(F.col("_ends"))
        inside = below(F.slice("_cuts", blocks * F.col("_block") + 1, F.col("_block")))
        return stored(placed.select(*self.df.columns, (blocks * F.col("_block") + inside).alias("_slice")), "slices")

    def _uncut(self) -> DataFrame:
        return self.df.join(small_side(self.cuts), _same_key(self.df, self.cuts, self.keys), "left_anti")

    def add(
        self,
        row_number: str | None = None,
        lag: Mapping[str, str] | None = None,
        lead: Mapping[str, str] | None = None,
        prior_sum: Mapping[str, str] | None = None,
        prior_count: Mapping[str, str] | None = None,
        last_known: Mapping[str, str] | None = None,
    ) -> DataFrame:
        """Add the named columns; mappings are new column -> source column.

        ``prior_sum`` and ``prior_count`` cover the rows strictly before the
        current one, as a frame that ends at ``1 PRECEDING`` does. ``last_known``
        is the newest non-NULL value up to and including the current row.
        """
        wanted = {
            "row_number": row_number,
            "lag": dict(lag or {}),
            "lead": dict(lead or {}),
            "prior_sum": dict(prior_sum or {}),
            "prior_count": dict(prior_count or {}),
            "last_known": dict(last_known or {}),
        }
        if not self.sliced:
            return self.df.withColumns(self._windowed(self.keys, ascending(self.df, self.order), wanted))
        if not self.keys:  # one group, and it is cut
            return self._add_sliced(wanted)
        cold = self._uncut()
        cold = cold.withColumns(self._windowed(self.keys, ascending(self.df, self.order), wanted))
        return self._add_sliced(wanted).unionByName(cold)

    def _windowed(self, keys: Sequence[str], order: Sequence[Column], wanted: dict) -> dict[str, Column]:
        w = Window.partitionBy(*keys).orderBy(*order)
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out: dict[str, Column] = {}
        if wanted["row_number"]:
            out[wanted["row_number"]] = F.row_number().over(w).cast("bigint")
        out |= {new: F.lag(old).over(w) for new, old in wanted["lag"].items()}
        out |= {new: F.lead(old).over(w) for new, old in wanted["lead"].items()}
        out |= {new: F.sum(old).over(before) for new, old in wanted["prior_sum"].items()}
        out |= {new: F.count(old).over(before) for new, old in wanted["prior_count"].items()}
        out |= {new: F.last(old, ignorenulls=True).over(so_far) for new, old in wanted["last_known"].items()}
        return out

    def _carry(self, wanted: dict) -> DataFrame:
        """What each slice of a hot key takes over from the slices around it."""
        keys = [*self.keys, "_slice"]
        order = F.struct(*self._whole_order())
        edges = sorted({*wanted["lag"].values(), *wanted["lead"].values()})
        edge = F.struct(*[F.col(c).alias(c) for c in edges], F.lit(0).alias("_pad"))
        measures = [F.count(F.lit(1)).alias("_n")]
        if edges:
            measures += [F.min_by(edge, order).alias("_first"), F.max_by(edge, order).alias("_last")]
        measures += [F.sum(old).alias(f"_s_{new}") for new, old in wanted["prior_sum"].items()]
        measures += [F.count(old).alias(f"_c_{new}") for new, old in wanted["prior_count"].items()]
        for new, old in wanted["last_known"].items():
            known = F.when(F.col(old).isNotNull(), order)
            measures.append(F.max_by(old, known).alias(f"_k_{new}"))
        summary = self.pieces.groupBy(*keys).agg(*measures)

        w = Window.partitionBy(*self.keys).orderBy("_slice")
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        carried = {"_size": F.col("_n"), "_o_n": F.sum("_n").over(before)}
        if edges:
            carried |= {"_o_prev": F.lag("_last").over(w), "_o_next": F.lead("_first").over(w)}
        carried |= {f"_o_s_{new}": F.sum(f"_s_{new}").over(before) for new in wanted["prior_sum"]}
        carried |= {f"_o_c_{new}": F.sum(f"_c_{new}").over(before) for new in wanted["prior_count"]}
        carried |= {f"_o_k_{new}": F.last(f"_k_{new}", ignorenulls=True).over(before) for new in wanted["last_known"]}
        return stored(_prefixed(summary.withColumns(carried).select(*keys, *carried), keys), "carry")

    def _add_sliced(self, wanted: dict) -> DataFrame:
        keys = [*self.keys, "_slice"]
        local = self.pieces.withColumns(self._windowed(keys, self._whole_order(), wanted | {"row_number": "_rn"}))
        carry = self._carry(wanted)
        joined = local.join(small_side(carry), _same_key(local, carry, keys), "left")
        out: dict[str, Column] = {}
        if wanted["row_number"]:
            out[wanted["row_number"]] = F.col("_rn") + F.coalesce("_o_n", F.lit(0))
        for new, old in wanted["lag"].items():
            out[new] = F.when(F.col("_rn") == 1, F.col(f"_o_prev.{old}")).otherwise(F.col(new))
        for new, old in wanted["lead"].items():
            out[new] = F.when(F.col("_rn") == F.col("_size"), F.col(f"_o_next.{old}")).otherwise(F.col(new))
        for new in wanted["prior_sum"]:
            here, earlier = F.col(new), F.col(f"_o_s_{new}")
            either = F.coalesce(here, F.lit(0)) + F.coalesce(earlier, F.lit(0))
            out[new] = F.when(here.isNotNull() | earlier.isNotNull(), either)
        for new in wanted["prior_count"]:
            out[new] = F.col(new) + F.coalesce(f"_o_c_{new}", F.lit(0))
        for new in wanted["last_known"]:
            out[new] = F.coalesce(new, f"_o_k_{new}")
        return joined.withColumns(out).select(*self.df.columns, *out)


def ranks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rank: str | None = None,
    dense_rank: str | None = None,
    plain_bytes: int = PLAIN_BYTES,
    **slicing,
) -> DataFrame:
    """Add ``rank`` and ``dense_rank`` of each row within its key.

    Rows that tie share a rank, so for large inputs the ranks are worked out on
    the distinct order values, counted before the shuffle, and joined back: no
    task has to hold the rows of one key or of one value.
    """
    keys = list(keys)
    if estimated_bytes(df) <= plain_bytes:
        w = Window.partitionBy(*keys).orderBy(*ascending(df, order))
        functions = {rank: F.rank, dense_rank: F.dense_rank}
        return df.withColumns({name: f().over(w).cast("bigint") for name, f in functions.items() if name})
    columns = [name.removeprefix("-") for name in order]
    values = df.groupBy(*keys, *columns).agg(F.count(F.lit(1)).alias("_n"))
    placed = KeySequence(values, keys, order, plain_bytes, **slicing).add(
        row_number="_dense", prior_sum={"_before": "_n"}
    )
    groups = [*keys, *columns]
    table = _prefixed(stored(placed, "ranks"), groups)
    joined = df.join(small_side(table), _same_key(df, table, groups), "left")
    found = {rank: F.coalesce("_before", F.lit(0)) + 1, dense_rank: F.col("_dense")}
    return joined.select(*df.columns, *[c.cast("bigint").alias(name) for name, c in found.items() if name])
