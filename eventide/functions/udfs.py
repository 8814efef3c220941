"""User-defined function surface (U1-U4) with native twins.

* Scalar function with a constructor argument (U1): registered as a SQL
  function whose body is a Spark SQL expression, so it is inlined into the
  plan and stays inside whole-stage codegen; an Arrow-batched pandas UDF is
  offered for callers that want Python.
* Table function, one row to n rows (U2): a Python UDTF for SQL
  ``LATERAL`` use; ``operators.lateral.lateral_split`` is the native form.
* Aggregate function with an accumulator (U3) and table aggregate function
  emitting n rows per group (U4): an ``Accumulator`` (create / add / merge /
  result) runs in two phases - per-partition partial accumulators in
  ``mapInPandas``, then a merge of at most one partial per partition and key
  in ``applyInPandas`` - so a group is never held whole by one task. From SQL
  the same accumulators are called as two table functions over a ``TABLE``
  argument (``register_aggregate``).
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ------------------------------------------------------------------ U1


def hash_code_sql(arg: str, factor: int) -> str:
    """SQL expression: Java ``String.hashCode(arg) * factor`` as a 32-bit int."""
    # A character outside the BMP folds as its two UTF-16 surrogates.
    step_bmp = "(acc * 31 + ascii(c)) % 4294967296"
    hi = "(55296 + shiftright(ascii(c) - 65536, 10))"
    lo = "(56320 + ((ascii(c) - 65536) & 1023))"
    step_sup = f"((((acc * 31 + {hi}) % 4294967296) * 31 + {lo}) % 4294967296)"
    unsigned = (f"aggregate(filter(split({arg}, ''), c -> length(c) > 0), 0L, "
                f"(acc, c) -> CASE WHEN ascii(c) > 65535 THEN {step_sup} ELSE {step_bmp} END)")
    signed = f"(CASE WHEN {unsigned} >= 2147483648 THEN {unsigned} - 4294967296 ELSE {unsigned} END)"
    scaled = f"pmod({signed} * {int(factor)}, 4294967296)"
    return f"CAST(CASE WHEN {scaled} >= 2147483648 THEN {scaled} - 4294967296 ELSE {scaled} END AS INT)"


def register_hash_code(spark: SparkSession, factor: int, name: str = "hash_code") -> str:
    """Register ``name(s STRING) -> INT`` for SQL; the factor is fixed at registration."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING) RETURNS INT "
              f"RETURN {hash_code_sql('s', factor)}")
    return name


def _java_hash(s: str) -> int:
    """Java ``String.hashCode`` over UTF-16 code units."""
    data = s.encode("utf-16-le")
    h = 0
    for i in range(0, len(data), 2):
        h = (31 * h + (data[i] | data[i + 1] << 8)) & 0xFFFFFFFF
    return h - (1 << 32) if h >= 1 << 31 else h


def hash_code_pandas(factor: int):
    """Arrow-batched pandas UDF computing the same value (Python path)."""
    f = int(factor)

    @F.pandas_udf(T.IntegerType())
    def _hash(s: pd.Series) -> pd.Series:
        def one(x):
            if x is None:
                return None
            v = (_java_hash(x) * f) & 0xFFFFFFFF
            return v - (1 << 32) if v >= 1 << 31 else v
        return s.map(one).astype("Int32")
    return _hash


# ------------------------------------------------------------------ U2

def make_split_udtf(separator: str = "#"):
    """Python UDTF ``split(s)`` -> rows (word, length), JVM ``String.split`` semantics."""
    import re

    from pyspark.sql.functions import udtf

    pat = re.compile(re.escape(separator))

    @udtf(returnType="word: string, length: int")
    class Split:
        def eval(self, s: str):
            if s is None:
                return
            parts = pat.split(s)
            while parts and parts[-1] == "" and len(parts) > 1:
                parts.pop()
            if s and all(p == "" for p in parts):
                return
            for w in parts:
                yield w, len(w)
    return Split


def register_split(spark: SparkSession, separator: str = "#", name: str = "split_words"):
    """Register the table function for ``LATERAL name(col)`` in SQL."""
    fn = make_split_udtf(separator)
    spark.udtf.register(name, fn)
    return fn


# ------------------------------------------------------------------ U3 / U4

class Accumulator:
    """Aggregate-function contract: create, add a batch of values, merge, result.

    The state is JSON-serialisable and, for SQL calls, a value of the Spark type
    ``state_type``; ``result`` returns a list of output tuples (one for an
    aggregate function, n for a table aggregate function).
    """

    state_type = "string"

    def create(self):
        raise NotImplementedError

    def add(self, acc, values: np.ndarray):
        raise NotImplementedError

    def merge(self, a, b):
        raise NotImplementedError

    def result(self, acc) -> list[tuple]:
        raise NotImplementedError


class AvgTemp(Accumulator):
    """Long sum / int count with truncating division."""

    state_type = "array<bigint>"

    def create(self):
        return [0, 0]

    def add(self, acc, values):
        v = values[~pd.isna(values)].astype("int64")
        return [acc[0] + int(v.sum()), acc[1] + int(len(v))]

    def merge(self, a, b):
        return [a[0] + b[0], a[1] + b[1]]

    def result(self, acc):
        s, c = acc
        if c == 0:
            return [(None,)]
        q = abs(s) // c
        return [(q if s >= 0 else -q,)]


DOUBLE_MIN = -1.7976931348623157e308


class TopK(Accumulator):
    """The ``k`` highest values (duplicates count); emits (value, rank) ``k`` times, missing ones as the smallest double."""

    def __init__(self, k: int):
        self.k = int(k)

    state_type = "array<double>"

    def create(self):
        return [DOUBLE_MIN] * self.k

    def add(self, acc, values):
        v = values[~pd.isna(values)].astype("float64")
        return self.merge(acc, np.partition(v, -self.k)[-self.k:].tolist() if len(v) > self.k else v.tolist())

    def merge(self, a, b):
        return sorted([*a, *b], reverse=True)[:self.k]

    def result(self, acc):
        return [(v, rank) for rank, v in enumerate(acc, start=1)]


class Top2(TopK):
    """Highest and second highest value."""

    def __init__(self):
        super().__init__(2)


def aggregate_with(df: DataFrame, keys, value: str, acc: Accumulator, out_schema: str) -> DataFrame:
    """Run an ``Accumulator`` per key in two phases (partial per partition, then merge).

    ``out_schema`` is the DDL of the result columns (after the key columns).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    key_fields = [df.schema[k] for k in keys]
    partial_schema = T.StructType(key_fields + [T.StructField("acc", T.StringType())])

    def partial(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        accs: dict = {}
        for pdf in it:
            for k, g in pdf.groupby(keys, sort=False, dropna=False):
                k = k if isinstance(k, tuple) else (k,)
                accs[k] = acc.add(accs.get(k, acc.create()), g[value].to_numpy())
        if accs:
            rows = [list(k) + [json.dumps(a)] for k, a in accs.items()]
            yield pd.DataFrame(rows, columns=[*keys, "acc"])

    parts = df.select(*keys, value).mapInPandas(partial, partial_schema)
    out_fields = list(T._parse_datatype_string(out_schema).fields)
    final_schema = T.StructType(key_fields + out_fields)
    names = [f.name for f in out_fields]

    def final(pdf: pd.DataFrame) -> pd.DataFrame:
        a = acc.create()
        for s in pdf["acc"]:
            a = acc.merge(a, json.loads(s))
        kv = [pdf[k].iloc[0] for k in keys]
        return pd.DataFrame([kv + list(r) for r in acc.result(a)], columns=[*keys, *names])

    return parts.groupBy(*keys).applyInPandas(final, final_schema)


def avg_temp(df: DataFrame, key, value: str, out: str = "avg_temp") -> DataFrame:
    """U3 through the accumulator path (native twin: ``aggregates.avg_long``)."""
    return aggregate_with(df, key, value, AvgTemp(), f"{out} BIGINT")


def top2_temp(df: DataFrame, key, value: str) -> DataFrame:
    """U4 through the accumulator path (native twin: ``aggregates.top2``)."""
    return aggregate_with(df, key, value, Top2(), "temp DOUBLE, rank INT")


def register_avg_temp(spark: SparkSession, name: str = "avg_temp"):
    """SQL-callable grouped-aggregate pandas UDF ``name(bigint) -> bigint``.

    Spark evaluates grouped-aggregate pandas UDFs without partial
    aggregation, so each group is materialised in one task; for large groups
    use ``sum(x) div count(x)`` (what ``aggregates.avg_long`` emits) or
    ``avg_temp`` above.
    """
    @F.pandas_udf(T.LongType())
    def _avg(v: pd.Series) -> int:
        a = AvgTemp()
        return a.result(a.add(a.create(), v.to_numpy()))[0][0]
    spark.udf.register(name, _avg)
    return _avg


#: A task of a partial table function holds the states of at most this many keys, then passes them on.
PARTIAL_KEYS = 50_000
#: Values that a task holds back to add them to their states in one go.
PARTIAL_VALUES = 8_192


def make_aggregate_udtfs(acc: Accumulator, out_schema: str):
    """Two table functions for SQL: partial states per task, and their merge per key.

    The input's last column is the value, the columns before it are the key.
    ``partial`` runs wherever the rows are, without a shuffle, and emits one
    state per key (again after PARTIAL_KEYS keys); ``merge`` is partitioned by
    the key columns and sees states only, so no task holds a group's rows.
    """
    from pyspark.sql.functions import udtf
    from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, PartitioningColumn

    state_type = T._parse_datatype_string(acc.state_type)
    out_fields = list(T._parse_datatype_string(out_schema).fields)

    @udtf
    class Partial:
        @staticmethod
        def analyze(rows: AnalyzeArgument) -> AnalyzeResult:
            return AnalyzeResult(T.StructType([*rows.dataType.fields[:-1], T.StructField("acc", state_type)]))

        def __init__(self):
            self.states, self.values, self.held = {}, {}, 0

        def eval(self, row):
            *key, value = row
            self.values.setdefault(tuple(key), []).append(value)
            self.held += 1
            if self.held >= PARTIAL_VALUES:
                self._add()
                if len(self.states) >= PARTIAL_KEYS:
                    yield from self._states()

        def _add(self):
            for key, values in self.values.items():
                state = self.states[key] if key in self.states else acc.create()
                self.states[key] = acc.add(state, np.array(values, dtype=object))
            self.values, self.held = {}, 0

        def _states(self):
            states, self.states = self.states, {}
            for key, state in states.items():
                yield (*key, state)

        def terminate(self):
            self._add()
            yield from self._states()

    @udtf
    class Merge:
        @staticmethod
        def analyze(rows: AnalyzeArgument) -> AnalyzeResult:
            keys = rows.dataType.fields[:-1]
            return AnalyzeResult(T.StructType([*keys, *out_fields]),
                                 partitionBy=[PartitioningColumn(f"`{f.name}`") for f in keys],
                                 withSinglePartition=not keys)

        def __init__(self):
            self.key = self.state = None

        def eval(self, row):
            *key, state = row
            self.state = acc.merge(acc.create() if self.key is None else self.state, list(state))
            self.key = tuple(key)

        def terminate(self):
            if self.key is not None:
                for out in acc.result(self.state):
                    yield (*self.key, *out)

    return Partial, Merge


def register_aggregate(spark: SparkSession, acc: Accumulator, name: str, out_schema: str) -> str:
    """Register ``acc`` for SQL as the table functions ``<name>_partial`` and ``<name>``::

        SELECT * FROM <name>(TABLE(SELECT * FROM <name>_partial(TABLE(SELECT key, value FROM t))))

    Returns that statement with ``{rows}`` in place of the innermost query.
    """
    partial, merge = make_aggregate_udtfs(acc, out_schema)
    spark.udtf.register(f"{name}_partial", partial)
    spark.udtf.register(name, merge)
    return f"SELECT * FROM {name}(TABLE(SELECT * FROM {name}_partial(TABLE({{rows}}))))"
