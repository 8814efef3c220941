"""Building blocks for keyed, ordered computations that must not put a whole
key on one task.

Event jobs are keyed (user, order, item) and a single key may carry a large
share of all rows, even within one second. ``cut`` deals the rows of each key,
in their order, into buckets of about ``ROWS_PER_BUCKET`` rows: the bounds are
quantiles of the key's own event times (a mergeable sketch), and where many
rows share one time, quantiles of their tie-break inside that time. Which keys
need cutting and where is part of the query itself: no job runs while a query
is built, and a key with fewer rows has one bucket.

On cut rows every operator is one window pass per (key, bucket) plus a small
table with one row per bucket of the cut keys:

* ``scan`` - running sums: the sum inside the bucket plus the totals of the
  key's earlier buckets (a two-level prefix sum);
* ``before`` / ``after`` - the nearest earlier (later) row that meets a
  condition: found in the bucket, or carried over from the buckets beside it;
* ``with_halo`` - for range frames: rows are copied into the following
  buckets whose frames reach back to them.

An input that one task could sort whole, by Spark's own size statistics (no
job), is left as it is: then the same operators are plain windows per key.

All steps of a chain share one shuffle of the rows by (key, bucket). The table
of bounds and the tables of bucket totals have at most 4 * ``MAX_BUCKETS``
rows whatever the input (buckets grow with the input beyond that), which is
what allows broadcasting them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "_bkt"
CUT = "_cut"
BOUNDS = "_bnd"
CONTEXT = "_ctx"
#: The one key of a computation without keys.
ALL = "_all"

#: Rows of a bucket: as many as a task sorts with ease.
ROWS_PER_BUCKET = 2_000_000
#: All cut keys together have at most about twice as many buckets; beyond that buckets get larger.
MAX_BUCKETS = 50_000
#: Most buckets of one key.
PARTS = 1_024
#: Inputs that Spark's statistics put below this are not cut at all: one task can sort them whole.
WHOLE_BYTES = 64_000_000


def join_keys(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``on`` where NULL keys match each other (``<=>``).

    ``groupBy`` and window partitions treat NULL as a key value; a plain
    equi-join would drop those rows. Spark still plans ``<=>`` keys as a
    hash or sort-merge join. Output: left columns, then right's other columns.
    """
    on = list(on)
    lcols, rcols = list(left.columns), [c for c in right.columns if c not in on]
    l, r = left.alias("__jl"), right.alias("__jr")

    def q(side, c):
        return F.col(f"{side}.`{c}`")
    cond = None
    for c in on:
        e = q("__jl", c).eqNullSafe(q("__jr", c))
        cond = e if cond is None else cond & e
    res = l.join(r, on=cond, how=how)
    if how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti"):
        return res
    return res.select(*[q("__jl", c) for c in lcols], *[q("__jr", c) for c in rcols])


def names(cols) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def _part(keys) -> list[str]:
    return names(keys) or [ALL]


def _add(x: Column, y: Column) -> Column:
    """Sum of two values of which either may be missing."""
    return F.when(x.isNull(), y).when(y.isNull(), x).otherwise(x + y)


def _point(a: Column, b: Column) -> Column:
    return F.struct(a.cast("long").alias("a"), b.cast("double").alias("b"))


def _tie(df: DataFrame, b: str | None) -> Column:
    """The tie-break as a number that never falls along its order; 0 if it has none (then ties are not cut)."""
    ordered = (T.NumericType, T.BooleanType, T.TimestampType)
    if b is None or not isinstance(df.schema[b].dataType, ordered):
        return F.lit(0.0)
    c = F.col(b)
    return (c.cast("int") if isinstance(df.schema[b].dataType, T.BooleanType) else c).cast("double")


def bounds(df: DataFrame, keys, a: str, b: str | None = None, rows: int | None = None) -> DataFrame:
    """(keys, ``_bnd``): for each key with more than a bucket's rows, the sorted first points (a, b) of its second and later buckets.

    One statement, which Spark analyses once: the sizes of the keys, the
    quantiles of the heavy ones, and, for a time that is several bounds at once
    (it holds more rows than a bucket), quantiles of the tie-break inside it.
    """
    keys = _part(keys)
    x = df.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keys)], F.col(a).cast("long").alias("a"), _tie(df, b).alias("b"))
    ks = [f"k{i}" for i in range(len(keys))]
    key = ", ".join(ks)

    def same(l: str, r: str) -> str:
        return " AND ".join(f"{l}.{k} <=> {r}.{k}" for k in ks)

    def of(t: str) -> str:
        return ", ".join(f"{t}.{k}" for k in ks)

    marks = "cast(split('" + ",".join(repr(i / PARTS) for i in range(1, PARTS)) + "', ',') AS array<double>)"

    def spread(n: str, last: str) -> str:
        """``last`` of the quantiles q, evenly spread for n buckets."""
        return f"explode(transform(sequence(1, {last}), i -> element_at(q, greatest(1, CAST(i * {PARTS} / ({n}) AS INT)))))"

    ties = f"""
      UNION ALL
      SELECT {key}, named_struct('a', a, 'b', b) AS at FROM (SELECT {key}, a, {spread('m + 1', 'CAST(m AS INT)')} AS b FROM (
        SELECT {of('x')}, x.a, c.m, percentile_approx(x.b, {marks}, {10 * PARTS}) AS q
        FROM x JOIN (SELECT /*+ BROADCAST */ * FROM firsts WHERE m > 1) c ON {same('x', 'c')} AND x.a = c.a GROUP BY {of('x')}, x.a, c.m)) WHERE b IS NOT NULL"""
    named = ", ".join(f"{k} AS `{c}`" for k, c in zip(ks, keys))
    return df.sparkSession.sql(f"""
      WITH x AS (SELECT * FROM {{rows}}),
      sizes AS (SELECT {key}, count(*) AS n FROM x GROUP BY {key}),
      heavy AS (SELECT * FROM (
        SELECT {key}, CAST(least({PARTS}, ceil(n / greatest({rows or ROWS_PER_BUCKET}, ceil((SELECT sum(n) FROM sizes) / {MAX_BUCKETS})))) AS INT) AS k FROM sizes) WHERE k > 1),
      marks AS (
        SELECT /*+ BROADCAST(h) */ {of('x')}, h.k, percentile_approx(x.a, {marks}, {10 * PARTS}) AS q
        FROM x JOIN heavy h ON {same('x', 'h')} GROUP BY {of('x')}, h.k),
      firsts AS (SELECT {key}, a, count(*) AS m FROM (SELECT {key}, {spread('k', 'k - 1')} AS a FROM marks) WHERE a IS NOT NULL GROUP BY {key}, a),
      points AS (
        SELECT {key}, named_struct('a', a, 'b', double('-infinity')) AS at FROM firsts{ties if b is not None else ''})
      SELECT {named}, array_sort(collect_set(at)) AS `{BOUNDS}` FROM points GROUP BY {key}""", rows=x)


def _bucket(a: Column, b: Column) -> Column:
    """How many bounds are at or before the point: a binary search."""
    steps, at = F.array(*[F.lit(PARTS >> k) for k in range(PARTS.bit_length())]), _point(a, b)
    found = F.aggregate(steps, F.lit(0), lambda n, s: F.when(F.get(BOUNDS, n + s - 1) <= at, n + s).otherwise(n))
    return F.when(F.col(BOUNDS).isNull(), F.lit(0)).otherwise(found)


def cut(df: DataFrame, keys, a: str, b: str | None = None, rows: int | None = None, keep_bounds: bool = False) -> DataFrame:
    """Add ``_bkt``, which never falls along (a, b) within a key, and ``_cut``, whether the key has several buckets.

    ``a`` is the order (epoch microseconds, a document number), ``b`` the
    tie-break; rows with equal (a, b) share a bucket. Without keys all rows are
    one key. Rows without ``a`` come first.
    """
    if not names(keys):
        df = df.withColumn(ALL, F.lit(0))
    if rows is None and _estimated_bytes(df) <= WHOLE_BYTES:
        return df
    marked = join_keys(df, F.broadcast(bounds(df, keys, a, b, rows)), _part(keys), "left")
    marked = marked.withColumn(BUCKET, _bucket(F.col(a), _tie(df, b))).withColumn(CUT, F.col(BOUNDS).isNotNull())
    return marked if keep_bounds else marked.drop(BOUNDS)


def _estimated_bytes(df: DataFrame) -> int:
    """Size of the input as Spark's optimizer estimates it from file sizes."""
    if not hasattr(df, "_jdf"):
        return 1 << 62
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def parts(d: DataFrame, keys) -> list[str]:
    """Columns that a window over the rows of ``d`` is partitioned by: the keys, and the bucket of cut rows."""
    return _part(keys) + ([BUCKET] if BUCKET in d.columns else [])


def uncut(df: DataFrame) -> DataFrame:
    return df.drop(BUCKET, CUT, BOUNDS, CONTEXT, ALL)


def _heavy(d: DataFrame) -> DataFrame:
    return d.where(CUT)


def scan(d: DataFrame, keys, order: Sequence[str], sums: dict[str, Column], frame: str = "rows") -> DataFrame:
    """Running sums along ``order`` within each key of cut rows.

    ``frame='range'`` includes the rows that tie on ``order[0]``, also those of
    later buckets. NULL only before the first value, as in one plain window.
    """
    part, first = _part(keys), order[0]
    win = Window.partitionBy(*parts(d, keys)).orderBy(*(order if frame == "rows" else order[:1]))
    win = win.rowsBetween(Window.unboundedPreceding, 0) if frame == "rows" else win.rangeBetween(Window.unboundedPreceding, 0)
    if BUCKET not in d.columns:
        return d.withColumns({n: F.sum(w).over(win) for n, w in sums.items()})
    weights = {f"__w_{n}": w for n, w in sums.items()}
    d = d.withColumns(weights)
    local = d.withColumns({f"__l_{n}": F.sum(f"__w_{n}").over(win) for n in sums})
    earlier = Window.partitionBy(*part).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    if frame == "rows":
        totals = _heavy(d).groupBy(*part, BUCKET).agg(*[F.sum(w).alias(w) for w in weights])
        carried = totals.select(*part, BUCKET, *[F.sum(f"__w_{n}").over(earlier).alias(f"__c_{n}") for n in sums])
    else:
        at = _heavy(d).groupBy(*part, BUCKET, first).agg(*[F.sum(w).alias(w) for w in weights])
        totals = at.groupBy(*part, BUCKET).agg(
            F.min(first).alias("__lo"), F.max(first).alias("__hi"), *[F.sum(w).alias(w) for w in weights],
            *[F.min_by(f"__w_{n}", first).alias(f"__h_{n}") for n in sums])
        # Of a time that runs on into later buckets: its rows there.
        onward = Window.partitionBy(*part, "__lo").orderBy(F.col(BUCKET).desc()).rowsBetween(Window.unboundedPreceding, 0)
        nxt = Window.partitionBy(*part).orderBy(BUCKET)
        heads = totals.withColumns({f"__s_{n}": F.sum(f"__h_{n}").over(onward) for n in sums})
        goes_on = F.lead("__lo").over(nxt) == F.col("__hi")
        carried = heads.select(*part, BUCKET, "__hi", *[F.sum(f"__w_{n}").over(earlier).alias(f"__c_{n}") for n in sums],
                               *[F.when(goes_on, F.lead(f"__s_{n}").over(nxt)).alias(f"__t_{n}") for n in sums])
    res = join_keys(local, F.broadcast(carried), [*part, BUCKET], "left")
    out = {}
    for n in sums:
        v = _add(F.col(f"__c_{n}"), F.col(f"__l_{n}"))
        if frame != "rows":
            v = _add(v, F.when(F.col(first) == F.col("__hi"), F.col(f"__t_{n}")))
        out[n] = v
    return res.withColumns(out).drop("__hi", *[f"__{x}_{n}" for x in "wlct" for n in sums])


def row_number(d: DataFrame, keys, order: Sequence[str], out: str = "rn") -> DataFrame:
    """1-based place of each row within its key, along ``order``."""
    return scan(d, keys, order, {out: F.lit(1).cast("long")})


def nearest(d: DataFrame, keys, order: Sequence[str], before: dict | None = None, after: dict | None = None) -> DataFrame:
    """Add the values of nearest rows of the same key: ``before`` maps a new column to (value, condition) of the last
    earlier row that meets the condition, ``after`` to those of the first later row. Values are never NULL (e.g.
    structs); the condition None is met by all rows. The column is NULL where there is no such row.
    """
    part = _part(keys)
    wanted = [(out, v, when, False) for out, (v, when) in (before or {}).items()] + [(out, v, when, True) for out, (v, when) in (after or {}).items()]
    values = {f"__v_{out}": v if when is None else F.when(when, v) for out, v, when, _ in wanted}

    def window(cols, down: bool):
        return [F.col(c).desc() if down else F.col(c).asc() for c in cols]

    def beside(down: bool):
        return Window.partitionBy(*parts(d, keys)).orderBy(*window(order, down)).rowsBetween(Window.unboundedPreceding, -1)

    def found(of) -> dict[str, Column]:
        """Inside the bucket: the row beside it if any will do, else the last one that counts, walking up to the row."""
        ahead = Window.partitionBy(*parts(d, keys)).orderBy(*order)
        return {out: (F.lead if down else F.lag)(of(out)).over(ahead) if when is None else F.last(of(out), ignorenulls=True).over(beside(down))
                for out, _, when, down in wanted}

    if BUCKET not in d.columns:
        return d.withColumns(found(lambda out: values[f"__v_{out}"]))
    d = d.withColumns(values)
    local = d.withColumns(found(lambda out: F.col(f"__v_{out}")))
    at = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    ends = _heavy(d).groupBy(*part, BUCKET).agg(*[
        (F.min_by if down else F.max_by)(f"__v_{out}", F.when(F.col(f"__v_{out}").isNotNull(), at)).alias(f"__e_{out}") for out, _, _, down in wanted])
    carried = ends.select(*part, BUCKET, *[
        F.last(f"__e_{out}", ignorenulls=True).over(Window.partitionBy(*part).orderBy(*window([BUCKET], down)).rowsBetween(Window.unboundedPreceding, -1)).alias(f"__c_{out}")
        for out, _, _, down in wanted])
    res = join_keys(local, F.broadcast(carried), [*part, BUCKET], "left")
    return res.withColumns({out: F.coalesce(out, f"__c_{out}") for out, _, _, _ in wanted}).drop(*[f"__{x}_{out}" for x in "vc" for out, _, _, _ in wanted])


def before(d: DataFrame, keys, order: Sequence[str], out: str, value: Column, when: Column | None = None) -> DataFrame:
    """Add ``out``: ``value`` of the last earlier row of the key that meets ``when`` (see ``nearest``)."""
    return nearest(d, keys, order, before={out: (value, when)})


def after(d: DataFrame, keys, order: Sequence[str], out: str, value: Column, when: Column | None = None) -> DataFrame:
    """As ``before``, of the first later row."""
    return nearest(d, keys, order, after={out: (value, when)})


def with_halo(d: DataFrame, a: str, reach: int) -> DataFrame:
    """Copy rows of cut keys (``cut(..., keep_bounds=True)`` without a tie-break) into the later buckets whose rows look back
    ``reach`` to them; ``_ctx`` marks the copies. The copies are as many as buckets lie within the reach."""
    if BUCKET not in d.columns:
        return d.withColumn(CONTEXT, F.lit(False))
    own = F.col(BUCKET)
    last = F.when(F.col(a).isNull(), own).otherwise(_bucket(F.col(a) + F.lit(reach), F.lit(float("inf"))))
    return (d.withColumn("__own", own).withColumn(BUCKET, F.explode(F.sequence(own, F.greatest(own, last))))
             .withColumn(CONTEXT, F.col(BUCKET) != F.col("__own")).drop("__own", BOUNDS))
