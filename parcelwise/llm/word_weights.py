"""Weights of hashed word features, learned and applied where the word before is.

A token is (u3, u2, u1, u0): its own unit and those of the three words before.  A unit is one
of the commonest words, or all others of a class together.  Every feature here holds u1, so
all tokens that share a feature lie in one group of tokens, which owns these weights:

* class softmax, on top of the logarithms that the histories of classes give: rows of one
  weight a class for the hashes of u1, of (u2, u1) and of the skip (u3, *, u1) that SHARED
  or more training tokens have;
* softmax of the units of a class, on top of their share in the class: one weight for each
  pair (u1, u0) and each (u2, u1, u0) seen in training.  A weight that is not there is zero,
  so the sum over a class is 1 plus what the units with weights add: (u2, u1, u0) has weights
  only where (u1, u0) has, and one sum per context is enough.

The pair weights start where absolute discounting would put them and are moved by gradient
updates until the model expects the discounted counts; class rows start at zero.
"""

from __future__ import annotations

import numpy as np

from .words import U, mix

DISCOUNT = 0.75
CLASS_UPDATES, UNIT_UPDATES = 2, 2
SHARED = 4  # training tokens that a feature of the class softmax must have
DAMPING, PULL = 4.0, 0.5  # keeps rows that few tokens share near zero
UNIT_BITS, CLASS_BITS = 20, 5
AT_A_TIME = 1 << 15


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(keys, return_inverse=True)


def unit_weights(u2, u1, u0, times, class_of, share, updates: int = UNIT_UPDATES) -> np.ndarray:
    """log p(u0 | class, history) - log share(u0) of each token; `times` are training counts."""
    low = (1 << 2 * UNIT_BITS) - 1
    triples, of_token = distinct((u2 << 2 * UNIT_BITS) | (u1 << UNIT_BITS) | u0)
    n3 = np.bincount(of_token, times, len(triples))
    pairs, pair = distinct(triples & low)
    n2 = np.bincount(pair, n3, len(pairs))
    word = pairs & ((1 << UNIT_BITS) - 1)
    wide = ((pairs >> UNIT_BITS) << CLASS_BITS) | class_of[word]  # (u1, class)
    contexts, context = distinct(wide)
    inner, of_triple = distinct((triples >> 2 * UNIT_BITS) << (UNIT_BITS + CLASS_BITS)
                                | wide[pair])
    outer = np.zeros(len(inner), np.int64)
    outer[of_triple] = context[pair]
    q = share[word]
    per_context = lambda x: np.bincount(context, x, len(contexts))
    per_inner = lambda x: np.bincount(of_triple, x, len(inner))

    spare2 = DISCOUNT * per_context(n2 > 0)[context] * q
    t2 = np.log1p(np.where(n2 > 0, (n2 - DISCOUNT) / np.maximum(spare2, 1e-300), 0.0))
    first = 1 + per_context(q * np.expm1(t2))
    p2 = q * np.exp(t2) / first[context]
    spare3 = DISCOUNT * per_inner(n3 > 0)[of_triple] * p2[pair]
    t3 = np.log1p(np.where(n3 > 0, (n3 - DISCOUNT) / np.maximum(spare3, 1e-300), 0.0))
    want2 = np.where(n2 > 0, n2 - DISCOUNT + spare2, 0.0)
    want3 = np.where(n3 > 0, n3 - DISCOUNT + spare3, 0.0)
    many = per_inner(n3)

    def sums() -> tuple[np.ndarray, np.ndarray]:
        wide_sum = 1 + per_context(q * np.expm1(t2))
        return wide_sum, wide_sum[outer] + per_inner((q * np.exp(t2))[pair] * np.expm1(t3))

    def step(want, have, n):
        return np.where(n > 0, (want - have) / (2 * np.maximum(np.maximum(want, have), 1e-300)), 0)

    for _ in range(updates):
        rate = many / sums()[1]
        mass = q * np.exp(t2)
        have3 = (mass[pair] * np.exp(t3)) * rate[of_triple]
        have2 = mass * (np.bincount(outer, rate, len(contexts))[context]
                        + np.bincount(pair, rate[of_triple] * np.expm1(t3), len(pairs)))
        t2, t3 = t2 + step(want2, have2, n2), t3 + step(want3, have3, n3)
    total = sums()[1]
    return (t2[pair] + t3 - np.log(total[of_triple]))[of_token]


def hashed_rows(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, int]:
    """The row of each token's feature, 0 if fewer than SHARED training tokens have its
    hash, and the number of rows."""
    bits = len(key).bit_length() + 1
    bucket = (mix(key.astype(U)) >> U(64 - bits)).astype(np.int64)
    shared = np.bincount(bucket, times, 1 << bits) >= SHARED
    number = np.where(shared, np.cumsum(shared, dtype=np.int32), np.int32(0))
    return number[bucket], int(shared.sum()) + 1


def class_rows(u3, u2, u1, u0, times, class_of, table, updates: int = CLASS_UPDATES) -> np.ndarray:
    """log p(class | words before) - log p(class | classes before) of each token."""
    none, classes = (1 << UNIT_BITS) - 1, table.shape[1]
    found = [hashed_rows((a << 2 * UNIT_BITS) | (b << UNIT_BITS) | u1, times)
             for a, b in ((none, none), (none, u2), (u3, none))]
    code = (class_of[u3] * classes + class_of[u2]) * classes + class_of[u1]
    _, pair = distinct(found[1][0].astype(np.int64) * found[2][1] + found[2][0])
    # Tokens whose histories have the same rows and classes are one past.
    _, first, past = np.unique((pair * found[0][1] + found[0][0]) * len(table) + code,
                               return_index=True, return_inverse=True)
    code, many = code[first], len(first)
    rows = [row[first] for row, _ in found]
    # One line a class: sums over tokens run along the lines.
    base = np.ascontiguousarray(table.T)
    weights = [np.zeros((classes, n), np.float32) for _, n in found]
    # Training counts by class and past: most classes of a past have none.
    some = times > 0
    spot, of_spot = distinct(class_of[u0[some]] * many + past[some])
    held = np.bincount(of_spot, times[some], len(spot)).astype(np.float32)
    n = np.bincount(past, times, many).astype(np.float32)
    blocks = [slice(a, min(a + AT_A_TIME, many)) for a in range(0, many, AT_A_TIME)]

    def model(part: slice) -> np.ndarray:
        x = base.take(code[part], 1)
        for row, w in zip(rows, weights):
            x += w.take(row[part], 1)
        x -= x.max(0)
        x -= np.log(np.exp(x).sum(0))
        return x

    members = []
    for row, w in zip(rows, weights):
        order = np.flatnonzero((n > 0) & (row > 0))
        if len(order):
            order = order[np.argsort(row[order], kind="stable")]
            starts = np.flatnonzero(np.diff(row[order], prepend=-1))
            at, of_past = row[order][starts], row[spot % many]
            own = of_past > 0
            cell = spot[own] // many * len(at) + np.searchsorted(at, of_past[own])
            seen = np.bincount(cell, held[own], classes * len(at)).astype(np.float32)
            members.append((w, at, order, starts, seen.reshape(classes, -1)))
    missing = np.empty((classes, many), np.float32)
    for _ in range(updates):
        for part in blocks:
            missing[:, part] = -n[part] * np.exp(model(part))
        missing.reshape(-1)[spot] += held
        for w, at, order, starts, seen in members:
            for line, had, weight in zip(missing, seen, w):  # one class at a time
                slope = np.add.reduceat(line[order], starts)
                curve = len(rows) * np.maximum(had, had - slope) + DAMPING
                weight[at] += (slope - PULL * weight[at]) / curve
    logs = missing
    for part in blocks:
        logs[:, part] = model(part) - base.take(code[part], 1)
    return logs[class_of[u0], past].astype(float)


def gains(u3, u2, u1, u0, times, class_of, share, table) -> np.ndarray:
    """What the word features add to the natural logarithm of each token's probability."""
    if not len(u0):
        return np.zeros(0)
    return unit_weights(u2, u1, u0, times, class_of, share) \
        + class_rows(u3, u2, u1, u0, times, class_of, table)
