"""Groups of rows and linked components, for the operators on pairs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F


def in_groups(rows: DataFrame, keys: list[str], work: Callable[[pd.DataFrame], pd.DataFrame],
              schema: str) -> DataFrame:
    """work(rows of one key), for groups of bounded size.

    Partitions are sorted by key and read as a stream, so many small groups cost little and
    only one batch plus one group are in memory.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            if not len(held):
                continue
            fresh = np.zeros(len(held), bool)
            for k in keys:
                v = held[k].to_numpy()
                fresh[1:] |= v[1:] != v[:-1]
            cuts = [0, *np.flatnonzero(fresh).tolist()]
            done = [work(held.iloc[a:b].reset_index(drop=True)) for a, b in zip(cuts, cuts[1:])]
            held = held.iloc[cuts[-1]:].reset_index(drop=True)
            done = [d for d in done if len(d)]
            if done:
                yield pd.concat(done, ignore_index=True)
        if held is not None and len(held):
            yield work(held)

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, schema)


def roots(linked: np.ndarray) -> np.ndarray:
    """Lowest reachable position of each row of a symmetric boolean matrix."""
    n = len(linked)
    label = np.arange(n)
    while True:
        low = np.where(linked, label[None, :], n).min(1, initial=n)
        new = np.minimum(label, low)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def components(edges: DataFrame, save: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """(node, component) for all nodes of edges (a, b); component is the smallest node
    reachable.

    Alternates two steps until nothing changes: every larger neighbour of a node is linked
    to the node's smallest one, then every smaller neighbour is.  The number of edges never
    grows, each round is stored, and a hub's neighbours stay spread over tasks.
    """
    links = save(edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        size = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if tuple(size) == before or not size[0]:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")) \
                .unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component"))
                             .distinct())
        before = tuple(size)
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(low, "u").where("v > u and v <> m") \
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"),
                                                           F.col("m").alias("v"))
        links = save(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "links")
