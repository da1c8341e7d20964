"""Order-dependent packing into batches; grouped pandas, one small group at a time."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import IntegerType, StructField, StructType


def budget_batches(rows: DataFrame, lane: str, key: str, size: str, budget: int) -> DataFrame:
    """(lane, key, batch): rows of a lane in key order fill batches of at most ``budget``; a larger row is a batch of its own."""
    schema = StructType([rows.schema[lane], rows.schema[key], StructField("batch", IntegerType())])

    def run(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(key)
        batch, used, at = 0, 0, []
        for n in p[size]:
            if used and used + n > budget:
                batch, used = batch + 1, 0
            at.append(batch)
            used += n
        return p[[lane, key]].assign(batch=pd.Series(at, index=p.index, dtype="int32"))

    return rows.select(lane, key, size).groupBy(lane).applyInPandas(run, schema)


def overlapping_batches(rows: DataFrame, lane: str, key: str, size: str, budget: int, overlap: int) -> DataFrame:
    """As budget_batches, but each batch repeats the last ``overlap`` rows of the one before, as far as the budget allows."""
    schema = StructType([rows.schema[lane], rows.schema[key], StructField("batch", IntegerType())])

    def run(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(key)
        items = list(zip(p[key], p[size], strict=True))
        out, now, used, batch = [], [], 0, 0
        for k, n in items:
            if now and used + n > budget:
                out += [(x, batch) for x, _ in now]
                carry = now[-overlap:] if overlap else []
                while carry and sum(m for _, m in carry) + n > budget:
                    carry = carry[1:]
                now, batch = list(carry), batch + 1
                used = sum(m for _, m in now)
            now.append((k, n))
            used += n
        out += [(x, batch) for x, _ in now]
        return pd.DataFrame({lane: p[lane].iloc[0], key: [x for x, _ in out], "batch": pd.Series([b for _, b in out], dtype="int32")})

    return rows.select(lane, key, size).groupBy(lane).applyInPandas(run, schema)


def component_batches(members: DataFrame, component: str, key: str, most: int) -> DataFrame:
    """(component, key, part): components of more than ``most`` members are split, in key order. ``pack_components`` also puts small ones together."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    place = F.row_number().over(Window.partitionBy(component).orderBy(key)) - 1
    return members.select(component, key, F.floor(place / most).cast("int").alias("part"))


def pack_components(members: DataFrame, lane: str, component: str, key: str, most: int) -> DataFrame:
    """(lane, component, key, batch): whole components, the largest first and then by their smallest key, fill batches of at most ``most`` members; a larger component is split into batches of its own.

    Only the list of a lane's components is packed in one task; members get their batch by join.
    """
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    sizes = members.groupBy(lane, component).agg(F.count("*").alias("n"), F.min(key).alias("first"))
    schema = StructType([members.schema[lane], members.schema[component], StructField("batch", IntegerType())])

    def run(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(["n", "first"], ascending=[False, True])
        batch, used, at = 0, 0, []
        for n in p["n"]:
            if used and (n > most or used + n > most):
                batch, used = batch + 1, 0
            at.append(batch)
            batch, used = (batch + -(-n // most), 0) if n > most else (batch, used + n)
        return p[[lane, component]].assign(batch=pd.Series(at, index=p.index, dtype="int32"))

    starts = sizes.groupBy(lane).applyInPandas(run, schema)
    both = members.select(lane, component, key).join(starts, [lane, component])
    place = F.row_number().over(Window.partitionBy(lane, component).orderBy(key)) - 1
    return both.select(lane, component, key, (F.col("batch") + F.floor(place / most)).cast("int").alias("batch"))
