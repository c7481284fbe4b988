"""Quality classifier by importance resampling.

Two generative models over hashed n-grams, one for trusted text (labelled good and not
toxic) and one for all raw text, give a log ratio per bucket.  Features are byte 4-grams of
the lower-cased text and the lengths of runs of one repeated word.

* `log_weight` is a document's mean log ratio times a reference length: how much likelier
  the trusted model finds it.
* a document's evidence adds up, over its distinct buckets, how far a ratio lies below
  -TOLERANCE (features common in raw text that trusted text does not have), over
  1 + features / EASE, because long texts meet more rare features by chance.
* byte 4-grams do not see a word made of common syllables.  Whole words and pairs of words
  have models of their own, of how many rejected and how many trusted labelled documents hold
  them, so a repetition neither adds nor dilutes.  Their evidence is over the root of
  1 + distinct words / WORD_EASE; a labelled document is judged without its own counts.
* a document is accepted if no evidence is beyond its limit.  Limits are those that part the
  labelled rows best, first for grams, then for words and pairs among what is still accepted.
  The column `evidence` is the largest share of a limit.
* Gumbel top-k draws a share of the accepted ones, without replacement and in proportion to
  their weights: log weight plus a Gumbel number from a hash of the id.

Both models count every document.  Labels are used through a sample of at most
`max_labels` rows, taken by a hash of the id; its ids are all that is broadcast besides the
table of ratios, whose size is fixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .names import free
from .words import LOWER, U, mix, word_hashes

BITS = 18
GRAM = 4
BLOCK = 4096
RUNS = 8
PART = 1 << 20  # bytes of a text handled at once
REFERENCE = 512
EASE = 10_000
TOLERANCE = 2.0
WORD_BITS = 20
WORD_EASE = 100
WORD_TOLERANCES = (2.5, 3.0)  # words, pairs


def distinct(buckets: np.ndarray) -> np.ndarray:
    """Sorted, each once; a sort of 32-bit numbers is quicker than a hash table."""
    buckets = np.sort(buckets.astype(np.int32))
    first = np.ones(len(buckets), bool)
    np.not_equal(buckets[1:], buckets[:-1], out=first[1:])
    return buckets[first]


def word_features(text: str | None, words: np.ndarray | None = None) -> list[np.ndarray]:
    """Distinct buckets of the words and of the pairs of neighbouring words; `words` are the
    text's hashes if they are known."""
    words = word_hashes(text) if words is None else words
    pairs = mix(words[1:] * U(0xD6E8FEB86659FD93) + words[:-1])
    return [distinct(mix(x) >> U(64 - WORD_BITS)) for x in (words, pairs)]


def features(text: str | None, words: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """Bucket numbers, in parts of bounded size."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw.strip():
        return
    raw = b" " + raw + b" "
    for at in range(0, len(raw), PART):
        data = LOWER[np.frombuffer(raw[at:at + PART + GRAM - 1], np.uint8)]
        n = len(data) - GRAM + 1
        if n > 0:
            code = np.ndarray((n,), ">u4", data, strides=(1,)).astype(U)  # each GRAM bytes
            yield (mix(code) >> U(64 - BITS)).astype(np.int64)
    words = word_hashes(text) if words is None else words
    same = words[1:] == words[:-1]
    if same.any():
        index = np.arange(len(same))
        run = index - np.maximum.accumulate(np.where(same, -1, index))
        runs = np.minimum(run[same], RUNS).astype(U)
        yield (mix(runs ^ U(0x5DEECE66D)) >> U(64 - BITS)).astype(np.int64)


@dataclass
class Model:
    ratios: np.ndarray  # float32, one per bucket
    words: tuple[np.ndarray, ...] = ()  # float32, what a word or a pair adds to its evidence
    limits: tuple[float, ...] = ()  # of grams, words, pairs

    def grams(self, text: str | None, words: np.ndarray | None = None) -> tuple[int, float, float]:
        """Number of features, log weight, evidence."""
        n, total, low = 0, 0.0, []
        for part in features(text, words):
            n += len(part)
            ratios = self.ratios[part]
            total += float(ratios.sum(dtype=np.float64))
            low.append(part[ratios < -TOLERANCE])
        if not n:
            return 0, 0.0, 0.0
        excess = -self.ratios[distinct(np.concatenate(low))].astype(np.float64) - TOLERANCE
        return n, REFERENCE * total / n, float(excess.sum() / (1 + n / EASE))

    def score(self, text: str | None) -> tuple[int, float, float]:
        """Number of features, log weight, largest share of a limit."""
        words = word_hashes(text)
        n, weight, evidence = self.grams(text, words)
        found = [evidence]
        if n and any(limit < float("inf") for limit in self.limits[1:]):
            found += [eased(table[b]) for table, b in zip(self.words, word_features(text, words))]
        return n, weight, max((of_limit(e, limit) for e, limit in zip(found, self.limits)),
                              default=0.0)


def eased(excess: np.ndarray) -> float:
    return float(excess.sum(dtype=np.float64) / (1 + len(excess) / WORD_EASE) ** 0.5)


def of_limit(evidence: float, limit: float) -> float:
    """At most 1 up to the limit."""
    if evidence <= limit:
        return evidence / limit if 0 < limit < float("inf") else 0.0
    return evidence / limit if limit > 0 else 1 + evidence


def word_excess(bad, trusted, n_bad: int, n_trusted: int, tolerance: float) -> np.ndarray:
    """How far log shares of rejected and trusted documents differ beyond the tolerance."""
    ratio = np.log((bad + 0.5) / (n_bad + 1)) - np.log((trusted + 0.5) / (n_trusted + 1))
    return np.maximum(ratio - tolerance, 0)


def label_sample(labels: DataFrame, max_labels: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ids and whether each is trusted; rows without an id or quality are left out,
    an id with several labels is trusted only if all of them say so."""
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    rows = labels.where("doc_id is not null and quality is not null") \
        .groupBy(F.col("doc_id").cast("long").alias("i")).agg(F.min(good).alias("good")) \
        .orderBy(F.xxhash64("i"), "i").limit(max_labels).toPandas().sort_values("i")
    return rows["i"].to_numpy(np.int64), rows["good"].to_numpy(bool)


def find(ids: np.ndarray, wanted: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Positions in sorted `ids` and whether each wanted id (null: no) is there."""
    if not len(ids):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    values = wanted.fillna(0).to_numpy(np.int64)
    at = np.minimum(np.searchsorted(ids, values), len(ids) - 1)
    return at, (ids[at] == values) & wanted.notna().to_numpy()


def fit(docs: DataFrame, labels: DataFrame, max_labels: int = 200_000, id_col: str = "doc_id",
        text_col: str = "text") -> Model:
    ids, good = label_sample(labels, max_labels)
    pairs = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t"))
    size = 1 << BITS

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = [np.zeros(size, np.int64) for _ in range(2)]
        held = [np.zeros(1 << WORD_BITS, np.int64) for _ in range(4)]
        n = np.zeros(BLOCK, np.int64)  # rejected and trusted documents
        for batch in batches:
            at, known = find(ids, batch["i"])
            trusted = known & (good[at] if len(good) else False)
            for text, labelled, yes in zip(batch["t"], known, trusted):
                words = word_hashes(text)
                for part in features(text, words):
                    np.add.at(counts[0], part, 1)
                    if yes:
                        np.add.at(counts[1], part, 1)
                if labelled:
                    n[int(yes)] += 1
                    for k, part in enumerate(word_features(text, words)):
                        held[2 * k + int(yes)][part] += 1
        rows = [(k, b, c[b:b + BLOCK].tobytes()) for k, c in enumerate([*counts, *held, n])
                for b in range(0, len(c), BLOCK) if c[b:b + BLOCK].any()]
        yield pd.DataFrame(rows, columns=["k", "b", "c"])

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict = {}
        for batch in batches:
            for k, b, c in batch.itertuples(index=False):
                one = np.frombuffer(c, np.int64)
                sums[k, b] = sums[k, b] + one if (k, b) in sums else one
        yield pd.DataFrame([(k, b, c.tobytes()) for (k, b), c in sums.items()],
                           columns=["k", "b", "c"])

    schema = "k int, b int, c binary"
    total = np.zeros((2, size))
    held = np.zeros((4, 1 << WORD_BITS), np.int32)
    n = np.zeros(BLOCK, np.int64)
    for k, b, c in pairs.mapInPandas(count, schema).repartition("k", "b") \
            .mapInPandas(add, schema).collect():  # at most 2**BITS / BLOCK rows a gram model
        target = total[k] if k < 2 else held[k - 2] if k < 6 else n
        target[b:b + BLOCK] += np.frombuffer(c, np.int64).astype(target.dtype)
    if not total[1].any():
        return Model(np.zeros(size, np.float32))
    share = np.log(total + 0.5) - np.log(total.sum(1, keepdims=True) + size / 2)
    model = Model((share[1] - share[0]).astype(np.float32))
    n_bad, n_good = int(n[0]), int(n[1])

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at, known = find(ids, batch["i"])
            rows = []
            for i in np.flatnonzero(known):
                text, yes = batch["t"].iat[i], bool(good[at[i]])
                hashes = word_hashes(text)
                found = [eased(word_excess(held[2 * k][w] - (not yes), held[2 * k + 1][w] - yes,
                                           n_bad - (not yes), n_good - yes, tolerance))
                         for k, (w, tolerance) in enumerate(zip(word_features(text, hashes),
                                                                WORD_TOLERANCES))]
                rows.append((model.grams(text, hashes)[2], *found, yes))
            yield pd.DataFrame(rows, columns=["grams", "words", "pairs", "g"])

    judged = pairs.mapInPandas(judge, "grams double, words double, pairs double, g boolean") \
        .toPandas()  # the sample only
    g = judged["g"].to_numpy(bool)
    kept, limits = np.ones(len(g), bool), []
    for column in ("grams", "words", "pairs"):
        e = judged[column].to_numpy(float)
        limits.append(best_limit(e[kept], g[kept], int(g.sum()), int((~g).sum())))
        kept &= e <= limits[-1]
    words = tuple(word_excess(held[2 * k], held[2 * k + 1], n_bad, n_good, tolerance)
                  .astype(np.float32) for k, tolerance in enumerate(WORD_TOLERANCES))
    return Model(model.ratios, words, tuple(limits))


def best_limit(evidence: np.ndarray, good: np.ndarray, n_good: int = 0,
               n_bad: int = 0) -> float:
    """Middle of the widest gap among the limits with the best balanced accuracy; without
    labelled bad rows, or if no limit is better than none, nothing is rejected.  n_good and
    n_bad count rows that are already rejected as well."""
    if good.all() or not good.any():
        return float("inf")
    order = np.argsort(evidence, kind="stable")
    e, g = evidence[order], good[order]
    # limit at e[i], keeps 0..i
    gain = np.cumsum(g) / (n_good or g.sum()) - np.cumsum(~g) / (n_bad or (~g).sum())
    last = np.r_[e[1:] != e[:-1], True]
    gain[~last] = -np.inf
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    if best[-1] == len(e) - 1:
        return float("inf")
    upper = e[best + 1]
    pick = int(np.argmax(upper - e[best]))
    return float((e[best[pick]] + upper[pick]) / 2)


def scores(text: Column, model: Model) -> Column:
    """struct(n_features, log_weight, evidence) of a text column."""

    @F.pandas_udf("n_features long, log_weight double, evidence double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([model.score(t) for t in texts],
                               columns=["n_features", "log_weight", "evidence"])

    return scored(text)


def gumbel(key: Column, seed: int) -> Column:
    """A standard Gumbel number from a hash; equal keys get equal numbers."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 11).cast("double")
    return -F.log(-F.log((bits + 0.5) / F.lit(float(1 << 53))))


def kth_largest(rows: DataFrame, column: str, k: int, exact_below: int = 10_000) -> float:
    """The k-th largest value by ever finer histograms; no sort, one task never sees more
    than `exact_below` values or one count per bin and task."""
    low, high, n = rows.agg(F.min(column), F.max(column), F.count(column)).first()
    if not n or k <= 0:
        return float("inf")
    if k >= n:
        return low
    within, left = rows, k
    while n > exact_below and high > low:
        width = (high - low) / 1000
        bins = within.groupBy(F.least(F.floor((F.col(column) - low) / width), F.lit(999))
                              .cast("int").alias("b")) \
            .agg(F.count(column).alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi"))
        for b in sorted(bins.collect(), key=lambda x: -x["b"]):
            if left <= b["n"]:
                break
            left -= b["n"]
        low, high, n = b["lo"], b["hi"], b["n"]
        within = rows.where(F.col(column).between(low, high))
    if high <= low:
        return low
    return sorted((r[0] for r in within.select(column).collect()), reverse=True)[left - 1]


def classify(docs: DataFrame, model: Model, score_col: str, accepted_col: str,
             text_col: str = "text") -> DataFrame:
    """The documents plus a struct column with the scores and a boolean one.

    Null, empty and blank texts have no feature: weight 0, evidence 0, accepted.
    """
    return docs.withColumn(score_col, scores(F.col(text_col), model)) \
        .withColumn(accepted_col, F.col(score_col).getField("evidence") <= 1)


def accepted(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that the classifier does not reject, with their own columns only."""
    model = fit(docs, labels, **options)
    names = free(docs, "_score", "_accepted")
    mine = [F.col(f"`{c}`") for c in docs.columns]
    return classify(docs, model, *names, options.get("text_col", "text")) \
        .where(F.col(names[1])).select(*mine)


def resample(docs: DataFrame, labels: DataFrame, save, share: float = 0.5, seed: int = 7,
             **options) -> DataFrame:
    """One row per document with its scores and whether the Gumbel draw takes it.

    `save` stores a frame and returns it reread, as the scores are used three times.
    Repeated ids draw the same number; documents that tie with the last one taken are taken
    as well.  Null ids draw as one id.  An empty table gives no rows.
    """
    model = fit(docs, labels, **options)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = save(classify(rows, model, "scores", "accepted")
                  .select("doc_id", "scores.*", "accepted")
        .withColumn("gumbel_key", F.col("log_weight") + gumbel(F.col("doc_id"), seed)), "scores")
    good = scored.where("accepted")
    edge = kth_largest(good, "gumbel_key", round(share * good.count()))
    return scored.withColumn("sampled", F.col("accepted") & (F.col("gumbel_key") >= edge))
