"""A hashed maximum-entropy language model with a class-factored softmax.

p(word | history) = p(class | history) * p(unit | class, history) * p(word | unit)

* Classes: word endings are hashed to 1024 bins; the bins' neighbour counts over the whole
  training text are clustered into 30 classes, besides one for the end and one for what is
  before the start.
* p(class | history) is a softmax.  Part of its weights belong to hashed features of the
  three classes before: n-grams and skip pairs.  Such histories become counts of
  (history, class), at most 32**4 of them; each update adds up gradients over all of these in
  tasks and sends one table of fixed size.  The other part belongs to hashed n-grams and
  skips of the words before (`word_weights`).
* A unit is one of the commonest words (at most `head` of them), or all others of a class.
  p(unit | class, history) is a softmax over the units of a class with weights of word
  n-grams that were seen, on top of the unit's share in the class.
* Weights of word features grow with the text.  They never meet on one machine: every such
  feature holds the word before, so tokens are dealt by that word into groups of about `GROUP`
  tokens, each of which learns and applies its own weights.  Where many tokens share the word
  before, its features also hold some hash bits of the word before that, and where many share
  those two words, of the third as well; the tokens are dealt by these.  So a group follows from
  the history alone, and each weight is learned from every training token with its feature.
* p(word | unit) and the shares are unigram, (c + 0.5) / (N_class + 0.5 (V_class + 1)), where
  the last half is for words not seen.  Counts are over all training documents; the commonest
  words are known to every task, counts of all others come by a join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .word_weights import gains
from .words import U, mix, word_batches

BINS = 1024
CLASSES = 32
START, END = 0, 1
HISTORIES = CLASSES ** 3
BUCKETS = 1 << 13
END_WORD = int(mix(np.array([1], U)).view(np.int64)[0])
UPDATES = 12
BLOCK = 4096
AT_ONCE = 1 << 20  # words that a task counts before it hands them on
GROUP = 1 << 19  # tokens that learn together
BATCH = 4 << 20  # bytes of rows that a task is handed at once
FIRST = 1 << 10  # units whose pairs are counted: classes and the commonest words
Save = Callable[[DataFrame, str], DataFrame]


def bins_of(endings: np.ndarray) -> np.ndarray:
    return (mix(endings.astype(U)) >> U(54)).astype(np.int64)


def with_ends(values: np.ndarray, bounds: np.ndarray, end) -> tuple[np.ndarray, np.ndarray]:
    """The end marker after each document's values; the new bounds."""
    return (np.insert(values, bounds[1:], end),
            bounds + np.arange(len(bounds)))


def histories(classes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Code of the three classes before each token."""
    n = len(classes)
    place = np.arange(n) - np.repeat(bounds[:-1], np.diff(bounds))
    code = np.zeros(n, np.int64)
    for back in (3, 2, 1):
        shifted = np.full(n, START, np.int64)
        shifted[back:] = classes[:-back] if back < n else classes[:0]
        code = code * CLASSES + np.where(place >= back, shifted, START)
    return code


def feature_buckets(code: np.ndarray) -> np.ndarray:
    """Hashed features of histories: bias, n-grams and skips; one row per history."""
    c3, c2, c1 = code // CLASSES ** 2, code // CLASSES % CLASSES, code % CLASSES
    none = np.full_like(code, CLASSES)
    parts = [(none, none, none), (none, none, c1), (none, c2, none), (c3, none, none),
             (none, c2, c1), (c3, none, c1), (c3, c2, none), (c3, c2, c1)]
    keys = [(a * 64 + b) * 64 + c for a, b, c in parts]
    return np.stack([(mix(k.astype(U) + U(k_i << 32)) >> U(64 - 13)).astype(np.int64)
                     for k_i, k in enumerate(keys)], 1)


def log_softmax(weights: np.ndarray, code: np.ndarray) -> np.ndarray:
    logits = weights[feature_buckets(code)].sum(1)
    logits -= logits.max(1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(1, keepdims=True))


def cluster(pairs: np.ndarray, classes: int, rounds: int = 25) -> np.ndarray:
    """A class (from 2) for each bin, by what stands beside it: correspondence analysis of
    the neighbour counts, then weighted k-means from the commonest bins outwards."""
    total = pairs.sum()
    if not total:
        return np.full(len(pairs), 2)
    p = pairs / total
    r, c = p.sum(1), p.sum(0)
    scale = np.sqrt(np.outer(r, c)) + 1e-300
    u, s, v = np.linalg.svd(np.where(scale > 1e-200, (p - np.outer(r, c)) / scale, 0))
    k = min(12, len(s))
    spot = np.concatenate([u[:, :k] * s[:k] / (np.sqrt(r)[:, None] + 1e-6),
                           v[:k].T * s[:k] / (np.sqrt(c)[:, None] + 1e-6)], 1)
    weight = r + c
    centre = spot[[int(weight.argmax())]]
    while len(centre) < classes:
        far = ((spot[:, None] - centre[None]) ** 2).sum(2).min(1) * weight
        centre = np.concatenate([centre, spot[[int(far.argmax())]]])
    for _ in range(rounds):
        label = ((spot[:, None] - centre[None]) ** 2).sum(2).argmin(1)
        for j in range(classes):
            w = weight[label == j]
            if w.sum():
                centre[j] = (spot[label == j] * w[:, None]).sum(0) / w.sum()
    return label + 2


def add_blocks(blocks: DataFrame) -> DataFrame:
    """Sums of equal-sized arrays per block number; what tasks found, added while it streams."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict = {}
        for batch in batches:
            for b, c in batch.itertuples(index=False):
                sums[b] = sums.get(b, 0) + np.frombuffer(c)
        yield pd.DataFrame([(b, c.tobytes()) for b, c in sums.items()], columns=["b", "c"])

    return blocks.repartition("b").mapInPandas(add, "b int, c binary")


def as_blocks(values: np.ndarray) -> pd.DataFrame:
    flat = values.reshape(-1)
    rows = [(i, flat[at:at + BLOCK].astype(np.float64).tobytes())
            for i, at in enumerate(range(0, len(flat), BLOCK)) if flat[at:at + BLOCK].any()]
    return pd.DataFrame(rows, columns=["b", "c"])


def gather(blocks: DataFrame, shape: tuple[int, ...]) -> np.ndarray:
    """A table of fixed size, on the driver."""
    out = np.zeros(int(np.prod(shape)))
    for b, c in add_blocks(blocks).collect():
        out[b * BLOCK:(b + 1) * BLOCK] = np.frombuffer(c)
    return out.reshape(shape)


def learn_classes(train: DataFrame) -> np.ndarray:
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs = np.zeros(BINS * BINS, np.int64)
        for batch in batches:
            for _, bounds, _, endings in word_batches(batch["t"]):
                if len(endings) > 1:
                    b = bins_of(endings)
                    inner = np.ones(len(b) - 1, bool)
                    cut = bounds[1:-1]
                    inner[cut[(cut > 0) & (cut < len(b))] - 1] = False
                    pairs += np.bincount((b[:-1] * BINS + b[1:])[inner], minlength=BINS * BINS)
        yield as_blocks(pairs)

    pairs = gather(train.select("t").mapInPandas(count, "b int, c binary"), (BINS, BINS))
    return cluster(pairs, CLASSES - 2)


def count_events(train: DataFrame, bin_class: np.ndarray) -> DataFrame:
    """(kind, key, class, n): kind 0 words by hash, kind 1 (history, class) codes."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held, codes, ends, size = [], [], 0, 0
            for _, bounds, hashes, endings in word_batches(batch["t"]):
                plain = bin_class[bins_of(endings)]
                classes, limits = with_ends(plain, bounds, END)
                codes.append(np.unique(histories(classes, limits) * CLASSES + classes,
                                       return_counts=True))
                held.append((hashes.view(np.int64), plain))
                ends += len(bounds) - 1
                size += len(hashes)
                if size > AT_ONCE:
                    yield summed(held, codes, ends)
                    held, codes, ends, size = [], [], 0, 0
            if held:
                yield summed(held, codes, ends)

    def summed(held: list, codes: list, ends: int) -> pd.DataFrame:
        words, at, n = np.unique(np.concatenate([h for h, _ in held]), return_index=True,
                                 return_counts=True)
        kind = np.concatenate([c for _, c in held])[at]
        code, back = np.unique(np.concatenate([c for c, _ in codes]), return_inverse=True)
        many = np.bincount(back, np.concatenate([n for _, n in codes]), len(code))
        return pd.DataFrame({
            "kind": np.repeat([0, 1], [len(words) + 1, len(code)]).astype(np.int32),
            "key": np.concatenate([words, [END_WORD], code]),
            "class": np.concatenate([kind, [END], np.zeros(len(code), int)]).astype(np.int32),
            "n": np.concatenate([n, [ends], many]).astype(np.int64)})

    return train.select("t").mapInPandas(count, "kind int, key long, class int, n long") \
        .groupBy("kind", "key").agg(F.max("class").alias("class"), F.sum("n").alias("n"))


def train_weights(events: DataFrame, updates: int = UPDATES) -> np.ndarray:
    """Weights by gradient updates over all (history, class) counts.

    The step of a weight is its gradient over the events that it takes part in, a lower bound
    of the curvature's inverse for the eight features that each history has.
    """
    weights = np.zeros((BUCKETS, CLASSES))
    seen = None
    for _ in range(updates):
        def slope(batches: Iterator[pd.DataFrame], weights=weights) -> Iterator[pd.DataFrame]:
            both = np.zeros((2, BUCKETS, CLASSES))
            for batch in batches:
                code = batch["key"].to_numpy(np.int64)
                n = batch["n"].to_numpy(float)
                past, back = np.unique(code // CLASSES, return_inverse=True)
                held = np.zeros((len(past), CLASSES))
                np.add.at(held, (back, code % CLASSES), n)
                model = np.exp(log_softmax(weights, past)) * held.sum(1, keepdims=True)
                for f in feature_buckets(past).T:
                    np.add.at(both[0], f, held)
                    np.add.at(both[1], f, model)
            yield as_blocks(both)

        found, expected = gather(events.select("key", "n").mapInPandas(slope, "b int, c binary"),
                                 (2, BUCKETS, CLASSES))
        seen = found if seen is None else seen
        weights = weights + 2.0 * (found - expected - 0.01 * weights) \
            / (found + expected + 1.0) / 8 * 2.0
    return weights


def commonest(words: DataFrame, head: int) -> pd.DataFrame:
    """The words at or above the lowest count level that at most `head` words reach."""
    level = F.floor(F.log2("n") * 16)
    levels = words.groupBy(level.alias("l")).agg(F.count(F.lit(1)).alias("k")).collect()
    total, lowest = 0, None
    for row in sorted(levels, key=lambda x: -x["l"]):
        total += row["k"]
        if total > head:
            break
        lowest = row["l"]
    none = words.where("false") if lowest is None else words.where(level >= lowest)
    return none.select("key", "n", "class").toPandas().sort_values(["n", "key"], ascending=False)


def held_out(id_col: str):
    """The remainder of the id's CRC is 1; rows without an id are training rows."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("long").cast("string")), F.lit(5)) == 1,
                      F.lit(False))


class Units:
    """What every task knows: the commonest words and the classes; of bounded size.

    Units below CLASSES are the other words of a class, then come the words by falling count.
    """

    def __init__(self, known: pd.DataFrame, n: np.ndarray, v: np.ndarray, bin_class: np.ndarray,
                 weights: np.ndarray, groups: int):
        self.groups, self.bin_class = groups, bin_class
        unseen = np.where(np.arange(CLASSES) == END, 0.0, 0.5)  # the end is its class's only word
        mass = n + 0.5 * v + unseen
        mass[END] = max(mass[END], 0.5)
        self.norm = np.log10(mass)
        count, classes = known["n"].to_numpy(np.int64), known["class"].to_numpy(np.int64)
        rest = np.bincount(classes, count, CLASSES), np.bincount(classes, minlength=CLASSES)
        rest = (n - rest[0]) + 0.5 * (v - rest[1]) + unseen
        self.class_of = np.concatenate([np.arange(CLASSES), classes])
        self.share = np.maximum(np.concatenate([rest, count + 0.5]), 1e-9) / mass[self.class_of]
        # Hash values of the word before a unit that its features hold, by its tokens.
        others = np.maximum(n - np.bincount(classes, count, CLASSES), 0).astype(np.int64)
        self.parts = 1 + 4 * np.concatenate([others, count]) // GROUP
        self.pair_parts = np.ones((FIRST, FIRST), np.int32)
        keys = known["key"].to_numpy(np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.unit = np.append(CLASSES + order, 0)
        self.value = np.append(np.log10(count[order] + 0.5), 0.0)
        self.table = np.concatenate([
            log_softmax(weights, np.arange(a, a + CLASSES ** 2))
            for a in range(0, HISTORIES, CLASSES ** 2)]).astype(np.float32)


def packed(*columns: np.ndarray) -> bytes:
    """Columns of 32-bit numbers, bytes of one weight together."""
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(-1, 4).T.tobytes() for c in columns]
    return pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def unpacked(blob: bytes, n: int, kinds: list) -> list[np.ndarray]:
    raw = pa.decompress(blob, 4 * n * len(kinds), codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(len(kinds), 4, n)
    return [np.ascontiguousarray(p.T).view(k).reshape(-1) for p, k in zip(planes, kinds)]


def before(units: np.ndarray, place: np.ndarray, back: int) -> np.ndarray:
    """The unit so many places before, in the same text."""
    shifted = np.full(len(units), START, units.dtype)
    shifted[back:] = units[:-back] if back < len(units) else units[:0]
    return np.where(place >= back, shifted, START)


def units_of(bounds: np.ndarray, hashes: np.ndarray, endings: np.ndarray, know: Units):
    """Of the tokens of some texts: hash, unit, class, place of the count and whether there is
    one; and the bounds of the texts."""
    classes, ends = with_ends(know.bin_class[bins_of(endings)], bounds, END)
    token, _ = with_ends(hashes.view(np.int64), bounds, END_WORD)
    at = np.searchsorted(know.keys, token)
    found = know.keys[at] == token
    return token, np.where(found, know.unit[at], classes), classes, at, found, ends


def pair_counts(train: DataFrame, shared) -> np.ndarray:
    """How many training tokens follow each pair of the first units, (u2, u1)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        know, pairs = shared.value, np.zeros(FIRST * FIRST, np.int64)
        for batch in batches:
            for _, bounds, hashes, endings in word_batches(batch["t"]):
                _, units, *_, limits = units_of(bounds, hashes, endings, know)
                u2, u1 = histories_of(units, limits)[1:]
                both = (u2 < FIRST) & (u1 < FIRST)
                pairs += np.bincount(u2[both] * FIRST + u1[both], minlength=FIRST * FIRST)
        yield as_blocks(pairs)

    return gather(train.select("t").mapInPandas(count, "b int, c binary"), (FIRST, FIRST))


def histories_of(units: np.ndarray, limits: np.ndarray) -> list[np.ndarray]:
    """The units three, two and one before each token."""
    place = np.arange(len(units)) - np.repeat(limits[:-1], np.diff(limits))
    return [before(units, place, back) for back in (3, 2, 1)]


def group_of(u3: np.ndarray, u2: np.ndarray, u1: np.ndarray, know: Units) -> np.ndarray:
    """The group that owns the weights of a history."""
    second = mix(u2.astype(U)) % know.parts[u1].astype(U)
    third = np.zeros(len(u1), U)
    both = np.flatnonzero((u2 < FIRST) & (u1 < FIRST))
    many = know.pair_parts[u2[both], u1[both]]
    both, many = both[many > 1], many[many > 1]
    third[both] = 1 + mix(u3[both].astype(U)) % many.astype(U)
    # A pair that is spread by the third word stands apart from the others of its word.
    second[both] = know.parts[u1[both]].astype(U) + u2[both].astype(U)
    with np.errstate(over="ignore"):
        return (mix(u1.astype(U) + (second << U(20)) + (third << U(44)))
                % U(know.groups)).astype(np.int64)


def deal(units: np.ndarray, tokens: np.ndarray, limits: np.ndarray, train: np.ndarray, know: Units):
    """Tokens of some texts by group: (group, number, packed columns), and for each text the
    number of the first that equals it.  Equal texts are dealt once, with their number."""
    size = np.diff(limits)
    place = np.arange(len(units)) - np.repeat(limits[:-1], size)
    mark = np.add.reduceat(mix(tokens.astype(U) + place.astype(U) * U(0x9E3779B97F4A7C15)),
                           limits[:-1])
    _, one, same = np.unique(np.stack([mark, size.astype(U)], 1), axis=0, return_index=True,
                             return_inverse=True)
    same = same.reshape(-1)
    times = np.bincount(same, train, len(one)).astype(np.uint32)
    keep = np.repeat(np.isin(np.arange(len(size)), one), size)
    doc = np.repeat(same, size)[keep]
    u = [x[keep] for x in (*histories_of(units, limits), units)]
    group = group_of(*u[:3], know)
    order = np.argsort((group << 20) | u[2], kind="stable")
    starts = np.flatnonzero(np.diff(group[order], prepend=-1))
    columns = [x[order].astype(np.uint32) for x in (doc, *u, times[doc])]
    found = [(int(group[order[a]]), int(b - a), packed(*[c[a:b] for c in columns]))
             for a, b in zip(starts, np.append(starts[1:], len(order)))]
    return found, same


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Rows reach Python in batches of BATCH bytes.  With Spark's usual number of rows, a batch
    of long texts is held several times over, by the JVM as well as by the worker."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    usual = spark.conf.get(key)
    spark.conf.set(key, str(BATCH))
    try:
        yield
    finally:
        spark.conf.set(key, usual)


def score(docs: DataFrame, save: Save, id_col: str = "doc_id", text_col: str = "text",
          head: int = 1 << 18) -> DataFrame:
    """Train on the documents that are not held out and score all of them.

    Defined cases: null texts are empty; an empty text is one end token; repeated rows count
    each time and give equal rows; without training documents every count is 0; an empty
    table gives no rows.  Other columns are ignored.
    """
    with small_batches(docs.sparkSession):
        return _score(docs, save, id_col, text_col, head)


def _score(docs: DataFrame, save: Save, id_col: str, text_col: str, head: int) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"),
                       held_out(id_col).alias("out"))
    train = rows.where("not out")
    bin_class = learn_classes(train)
    events = save(count_events(train, bin_class), "events")
    words = events.where("kind = 0")
    weights = train_weights(events.where("kind = 1"))
    sizes = words.groupBy("class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    n, v = np.zeros((2, CLASSES))
    for r in sizes:
        n[r["class"]], v[r["class"]] = r["n"], r["v"]
    total, distinct = int(n.sum()), int(v.sum())
    volume = rows.agg(F.sum(F.octet_length("t") + 1)).first()[0] or 0
    groups = 1 + volume // (4 * GROUP)
    units = Units(commonest(words, head), n, v, bin_class, weights, groups)
    context = docs.sparkSession.sparkContext
    if units.parts.max() > 1:
        first = context.broadcast(units)
        units.pair_parts = (1 + 4 * pair_counts(train, first).astype(np.int64) // GROUP) \
            .astype(np.int32)
        first.unpersist()
    shared = context.broadcast(units)

    def first_part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        know, task = shared.value, TaskContext.get().partitionId() << 32
        held, size, number = [], 0, 0
        for batch in batches:
            for first, bounds, hashes, endings in word_batches(batch["t"]):
                some = batch.iloc[first:first + len(bounds) - 1]
                held.append((some["i"], some["out"], bounds, hashes, endings))
                size += len(hashes) + len(bounds)
                if size > AT_ONCE:
                    yield block(held, know, task + number)
                    held, size, number = [], 0, number + 1
        if held:
            yield block(held, know, task + number)

    def block(held: list, know: Units, number: int) -> pd.DataFrame:
        """The documents' own row (a negative group) and their tokens by group."""
        docs, tokens, units, limits = [], [], [], [np.zeros(1, np.int64)]
        while held:  # what is done with is let go
            i, out, bounds, hashes, endings = held.pop(0)
            token, unit, classes, at, found, ends = units_of(bounds, hashes, endings, know)
            per = lambda x: np.add.reduceat(x, ends[:-1])  # noqa: E731  no text is empty
            code = histories(classes, ends)
            rare = [np.unique(token[a:b][~found[a:b]], return_counts=True)
                    for a, b in zip(ends[:-1], ends[1:])]
            docs.append(pd.DataFrame({
                "i": i.astype("Int64"), "out": out, "n_tokens": np.diff(ends),
                "n_common": per(found.astype(np.int64)),
                "class_part": per(know.table[code, classes].astype(float) / np.log(10)
                                  - know.norm[classes]),
                "word_part": per(np.where(found, know.value[at], 0.0)),
                "rare": [w for w, _ in rare], "times": [k for _, k in rare]}))
            tokens.append(token)
            units.append(unit.astype(np.int32))
            limits.append(ends[1:] + limits[-1][-1])
        docs = pd.concat(docs, ignore_index=True)
        dealt, docs["same"] = deal(np.concatenate(units), np.concatenate(tokens),
                                   np.concatenate(limits), ~docs["out"].to_numpy(bool), know)
        table = pa.Table.from_pandas(docs, preserve_index=False)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(
                compression="zstd")) as to:
            to.write_table(table)
        own = (-1 - int(mix(np.array([number], U))[0] % U(know.groups)), len(docs),
               sink.getvalue().to_pybytes())
        return pd.DataFrame([(g, number, n, b) for g, n, b in [own, *dealt]],
                            columns=["g", "block", "n", "blob"])

    def learn(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        if key[0] < 0:
            return group[["g", "block", "n", "blob"]]
        know, group = shared.value, group.sort_values("block")
        parts = [unpacked(b, n, [np.uint32] * 6) for b, n in zip(group["blob"], group["n"])]
        doc, *u = [np.concatenate(c) for c in zip(*parts)]
        del parts
        *u, times = [x.astype(np.int64) for x in u]
        gain = gains(*u, times, know.class_of, know.share, know.table) / np.log(10)
        out, at = [], 0
        for number, n in zip(group["block"], group["n"]):
            here, back = np.unique(doc[at:at + n], return_inverse=True)
            total = np.bincount(back, gain[at:at + n], len(here)).astype(np.float32)
            out.append((key[0], number, len(here), packed(here.astype(np.uint32), total)))
            at += n
        return pd.DataFrame(out, columns=["g", "block", "n", "blob"])

    def together(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("g")  # the documents' own row is the only negative one
        with pa.ipc.open_stream(block["blob"].iloc[0]) as stream:
            found = stream.read_pandas()
        gain = np.zeros(len(found))
        for blob, n in zip(block["blob"].iloc[1:], block["n"].iloc[1:]):
            at, more = unpacked(blob, n, [np.uint32, np.float32])
            gain[at] += more
        found["class_part"] += gain[found.pop("same")]
        found["i"] = found["i"].astype("Int64")
        return found

    parts = "g long, block long, n int, blob binary"
    done = save(rows.mapInPandas(first_part, parts).groupBy("g").applyInPandas(learn, parts)
                .groupBy("block").applyInPandas(
        together, "i long, out boolean, n_tokens long, n_common long, class_part double, "
        "word_part double, rare array<long>, times array<long>")
        .withColumn("row", F.monotonically_increasing_id()), "scored")
    spread = done.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")) \
        .select("row", F.col("x.rare").alias("key"), F.col("x.times").alias("k"))
    seen = F.coalesce("n", F.lit(0).cast("long"))
    others = spread.join(words.select("key", "n"), "key", "left").groupBy("row").agg(
        F.sum(F.col("k") * F.log10(seen + 0.5)).alias("rare_part"),
        F.sum(F.when(F.col("n").isNotNull(), F.col("k")).otherwise(0)).alias("n_rare"))
    word_part = F.col("word_part") + F.coalesce("rare_part", F.lit(0.0))
    whole = float(np.log10(total + 0.5 * (distinct + 1)))
    return done.drop("rare", "times").join(others, "row", "left").select(
        F.col("i").alias("doc_id"), F.col("out").alias("held_out"), "n_tokens",
        (F.col("n_common") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (word_part - F.col("n_tokens") * whole).alias("base_score"),
        (word_part + F.col("class_part")).alias("score"))
