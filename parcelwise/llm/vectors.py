"""Near-duplicate vectors inside each label by PCA-ordered tiled comparison.

Equal vectors of a label form a class.  Classes are dealt into tiles, and every pair of
tiles of a label is one unit of work, so a label of any size is spread over tasks.  There
vectors are scaled to length 1 and rotated to principal axes (of the second moment of all
valid rows; a rotation keeps cosines).  Products are added up over the leading axes first;
by Cauchy-Schwarz the rest of a product is at most the product of the two suffix norms, and
a pair whose bound stays under the threshold is dropped.  Pairs that are left get their
cosine from the original components in double precision.  A unit of work returns one row
per class: its number of links there and the root of its links' forest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .groups import components, in_groups, roots

TILE = 1024
FIRST_AXES = 8
SLACK = 1e-9
CHUNK = 1 << 15
Save = Callable[[DataFrame, str], DataFrame]


def usable(vector: Column, label: Column) -> Column:
    """A label, and finite components that are not all zero."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(label.isNotNull() & F.forall(vector, fine)
                      & F.exists(vector, lambda x: x != 0), F.lit(False))


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Per dimension the orthonormal axes, those with most weight first."""

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, rows in batch.groupby(batch["v"].map(len))["v"]:
                x = unit(np.stack(rows.to_numpy()))[0]
                sums[d] = sums.get(d, 0) + x.T @ x
        yield pd.DataFrame([(d, m.tobytes()) for d, m in sums.items()], columns=["d", "m"])

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, m in batch.itertuples(index=False):
                sums[d] = sums.get(d, 0) + np.frombuffer(m)
        yield pd.DataFrame([(d, m.tobytes()) for d, m in sums.items()], columns=["d", "m"])

    schema = "d int, m binary"
    found = vectors.mapInPandas(moments, schema).repartition("d").mapInPandas(add, schema)
    axes = {}
    for d, m in found.collect():  # one d x d matrix per dimension that occurs
        axes[d] = np.linalg.eigh(np.frombuffer(m).reshape(d, d))[1][:, ::-1]
    return axes


def unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length 1 and the lengths; scaled first, so squares neither overflow nor vanish."""
    x = x.astype(np.float64)
    top = np.abs(x).max(1, keepdims=True)
    y = x / top
    length = np.sqrt((y * y).sum(1, keepdims=True))
    return y / length, (top * length)[:, 0]


def linked_pairs(x: np.ndarray, left: np.ndarray, right: np.ndarray, axes: np.ndarray,
                 least: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j) with cosine >= least, i from left and j from right."""
    one, length = unit(x)
    turned = one @ axes
    tail = np.sqrt(np.maximum(0, np.cumsum((turned ** 2)[:, ::-1], 1)[:, ::-1]))
    tail = np.concatenate([tail, np.zeros((len(x), 1))], 1)  # norm of axes k and after
    dims, k = x.shape[1], min(FIRST_AXES, x.shape[1])
    part = turned[left, :k] @ turned[right, :k].T
    i, j = np.nonzero(part + np.outer(tail[left, k], tail[right, k]) >= least - SLACK)
    value = part[i, j]
    i, j = left[i], right[j]
    while k < dims and len(i):
        to = min(dims, 2 * k)
        for at in range(0, len(i), CHUNK):
            s = slice(at, at + CHUNK)
            value[s] += np.einsum("ij,ij->i", turned[i[s], k:to], turned[j[s], k:to])
        k = to
        live = value + tail[i, k] * tail[j, k] >= least - SLACK
        i, j, value = i[live], j[live], value[live]
    near = np.zeros(len(i), bool)
    x = x.astype(np.float64)
    for at in range(0, len(i), CHUNK):
        s = slice(at, at + CHUNK)
        exact = np.einsum("ij,ij->i", x[i[s]], x[j[s]])
        size = length[i[s]] * length[j[s]]
        near[s] = np.where(np.isfinite(exact) & (size > 0) & np.isfinite(size),
                           exact / size, value[s]) >= least
    return i[near], j[near]


def near_vectors(vectors: DataFrame, save: Save, least: float = 0.93, id_col: str = "vec_id",
                 vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector.

    Defined cases: vectors that are null, empty, zero or hold null or non-finite components,
    and vectors without a label, link with nothing, nor do vectors of different length; rows
    that share an id are vectors of their own for the counts and one node for components;
    rows without an id have a null component; an empty table gives no rows.  Other columns
    are ignored.
    """
    no_id = -(1 << 63)
    rows = vectors.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(no_id)).alias("i"),
        F.col(label_col).alias("label"), F.col(vector_col).alias("v"),
        usable(F.col(vector_col), F.col(label_col)).alias("ok"))
    axes = principal_axes(rows.where("ok").select("v"))
    classes = save(rows.where("ok").groupBy("label", "v").agg(
        F.min("i").alias("rep"), F.count(F.lit(1)).alias("w")), "classes")
    tiles = classes.groupBy("label", F.size("v").alias("d")).agg(
        F.ceil(F.count(F.lit(1)) / TILE).alias("k"))
    placed = classes.withColumn("d", F.size("v")).join(tiles, ["label", "d"]) \
        .withColumn("c", F.xxhash64("v")) \
        .withColumn("tile", F.pmod("c", F.col("k")))
    pairs = placed.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1))
                          .alias("other")).select(
        F.xxhash64("label", "d").alias("g"), F.least("tile", "other").alias("ta"),
        F.greatest("tile", "other").alias("tb"), "tile", "label", "rep", "w", "v", "d")

    def work(group: pd.DataFrame) -> pd.DataFrame:
        done = [one(part.reset_index(drop=True)) for _, part in group.groupby(["label", "d"])]
        return pd.concat(done, ignore_index=True)

    def one(group: pd.DataFrame) -> pd.DataFrame:
        n, tile = len(group), group["tile"].to_numpy()
        x = np.stack(group["v"].to_numpy())
        same = group["ta"].iat[0] == group["tb"].iat[0]
        first = tile == group["ta"].iat[0]
        left = np.arange(n) if same else np.flatnonzero(first)
        right = left if same else np.flatnonzero(~first)
        linked = np.zeros((n, n), bool)
        if len(left) and len(right):
            i, j = linked_pairs(x, left, right, axes[int(group["d"].iat[0])], least)
            linked[i, j] = linked[j, i] = True
            np.fill_diagonal(linked, False)
        ids = group["rep"].to_numpy()
        return pd.DataFrame({"rep": ids, "label": group["label"], "v": group["v"],
                             "root": ids[roots(linked)],
                             "links": linked @ group["w"].to_numpy(np.int64)})

    kinds = dict(classes.dtypes)
    found = save(in_groups(pairs, ["g", "ta", "tb"], work,
                           f"rep long, label {kinds['label']}, v {kinds['v']}, root long, "
                           "links long"), "links")
    links = found.groupBy("label", "v").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")), save)
    known = classes.join(links, ["label", "v"]).join(
        parts.withColumnRenamed("node", "rep"), "rep", "left").select(
        "label", "v", F.lit(True).alias("ok"), (F.col("links") + F.col("w") - 1).alias("links"),
        F.coalesce("component", "rep").alias("component"))
    shown = lambda c: F.when(F.col(c) != no_id, F.col(c))
    return rows.join(known, ["label", "v", "ok"], "left").select(
        shown("i").alias("vec_id"), F.coalesce("links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component", "i").alias("component_id")) \
        .withColumn("component_id", shown("component_id")) \
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
