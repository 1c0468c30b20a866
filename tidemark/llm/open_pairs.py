"""Pairs inside groups that must still be compared: those of members not in one component yet.

Members of a group are dealt to blocks. The members of the group's most frequent component are one
side only: they meet the others, not each other. All other members meet each other too. So a group
in which one component has all but a few members costs little more than its number of members, and
no pair is left out, however large the group is.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage

#: Members of one component or other in a block, and rows of blocks that a task compares at a time.
BLOCK = 512
TASK_ROWS = 8_192


def open_pairs(rows: DataFrame, by: list[str], block: int = BLOCK) -> DataFrame:
    """(deal, pair, side, node, component), staged, from rows with `by`, node and component, which are distinct.

    Rows of one `pair` are the two blocks that meet, side 0 and side 1; a block that meets itself
    has side 0 only. `deal` puts pairs together for a task.
    """
    each = rows.groupBy(*by, "component").agg(F.count("*").alias("_n"))
    most = each.groupBy(*by).agg(
        F.sum("_n").alias("_all"), F.max(F.struct("_n", "component")).alias("_most")
    ).filter("_all > _most._n").select(*by, "_all", "_most")
    alone = F.col("_most._n") > 1  # a component of one member is no side of its own
    most = most.select(
        *by, F.when(alone, F.col("_most.component")).alias("_main"),
        F.ceil((F.col("_all") - F.when(alone, F.col("_most._n")).otherwise(0)) / block).cast("int").alias("_rest"),
        F.when(alone, F.ceil(F.col("_most._n") / block)).otherwise(0).cast("int").alias("_mains"),
    )
    dealt = rows.join(most, by).withColumn("_in", F.coalesce(F.col("component") == F.col("_main"), F.lit(False)))
    dealt = dealt.withColumn("_at", F.pmod(F.xxhash64("node"), F.when(F.col("_in"), F.col("_mains")).otherwise(F.col("_rest"))).cast("int"))
    meets = F.expr("""if(_in,
        transform(sequence(0, _rest - 1), o -> struct(o as i, _rest + _at as j, 1 as side)),
        concat(
            transform(sequence(0, _rest - 1), o -> struct(least(o, _at) as i, greatest(o, _at) as j, int(_at > o) as side)),
            if(_mains = 0, array(), transform(sequence(0, greatest(_mains, 1) - 1), o -> struct(_at as i, _rest + o as j, 0 as side)))
        ))""")
    dealt = dealt.select(*by, "node", "component", F.explode(meets).alias("_meet"))
    dealt = stage(dealt.select(F.xxhash64(*by, "_meet.i", "_meet.j").alias("pair"), "_meet.side", "node", "component"), "open-pairs")
    deals = max(1, math.ceil(dealt.count() / TASK_ROWS))
    return dealt.withColumn("deal", F.pmod(F.xxhash64("pair"), F.lit(deals)))


def compared(rows: DataFrame, close: Callable[[pd.DataFrame, pd.DataFrame], np.ndarray]) -> DataFrame:
    """(a, b): spanning links of the open pairs for which `close` holds.

    `rows` are those of `open_pairs` with what `close` needs; `close` gives a matrix of truth values,
    left rows by right rows.
    """
    from tidemark.llm.minhash import _forest

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        one, two = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for left, right in _blocks(pdf):
            x, y = np.nonzero(close(left, right) & (left["component"].to_numpy()[:, None] != right["component"].to_numpy()[None, :]))
            a, b = left["node"].to_numpy()[x], right["node"].to_numpy()[y]
            if len(a):
                nodes, places = np.unique(np.concatenate([a, b]), return_inverse=True)
                kept = _forest(len(nodes), places.reshape(2, -1).T)
                one.append(nodes[[k[0] for k in kept]])
                two.append(nodes[[k[1] for k in kept]])
        return pd.DataFrame({"a": np.concatenate(one), "b": np.concatenate(two)})

    return rows.groupBy("deal").applyInPandas(links, "a long, b long")


def _blocks(pdf: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, pd.DataFrame]]:
    pdf = pdf.sort_values(["pair", "side"], kind="stable")
    pair, side = pdf["pair"].to_numpy(), pdf["side"].to_numpy()
    edges = np.concatenate([[0], np.flatnonzero(np.diff(pair)) + 1, [len(pdf)]])
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        cut = lo + int(np.searchsorted(side[lo:hi], 1))
        if lo < cut:
            yield pdf.iloc[lo:cut], pdf.iloc[lo:cut] if cut == hi else pdf.iloc[cut:hi]
