"""The whole Merkle tree, the likeness and the order of neighbours against plain Python."""

import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")
from parcelwise.llm import fingerprints as fp  # noqa: E402
from parcelwise.llm.neighbours import GROUP, QUANTILES, Ranges, with_next  # noqa: E402

dice = random.Random(8)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaves(line):
    out = []
    for s in [x for x in re.split(r"(?<=[.!?] )|(?<=[。！？])", line) if x] or [""]:
        out += re.findall(fp.CUT.replace(r"\z", r"\Z"), s) if len(s) > fp.LONG else [s]
    return out


def plain_print(text):
    sections, open_ = [], []
    for line in text.split("\n"):
        leaves = [sha(x) for x in plain_leaves(line)]
        open_.append((sha("".join(leaves)), ".".join(x[:fp.CODE] for x in leaves)))
        if open_[-1][0][0] < "4":
            sections, open_ = [*sections, open_], []
    sections += [open_] if open_ else []
    nodes = [(sha("".join(d for d, _ in s)), ",".join(f"{d[:fp.CODE]}-{x}" for d, x in s))
             for s in sections]
    return sha("".join(d for d, _ in nodes)) + ":" + ";".join(
        f"{d[:fp.CODE]}={x}" for d, x in nodes)


def plain_likeness(a, b):
    if a.split(":")[0] == b.split(":")[0]:
        return 1.0
    x, y = (set(re.findall(rf"[-.]([0-9a-f]{{{fp.CODE}}})", s.split(":")[1])) for s in (a, b))
    return min(2.0 * len(x & y) / (len(x) + len(y)), 0.999999)


def some_text(n):
    words = ["alpha", "beta.", "gamma!", "né", "漢字。", "x\ty", "end.\n", "\n\n", "?", "  ", "d\r"]
    return " ".join(dice.choice(words) for _ in range(n))


TEXTS = [(10 * i, some_text(dice.randrange(90))) for i in range(120)] + [
    (3, None), (4, ""), (5, "\n"), (6, "word" * 200), (7, "a. " * 300), (8, "k " * 400 + "\r"),
    (None, "one"), (None, "two"), (None, None), (10**18, "far away"), (55, "same"), (55, "same")]


def test_whole_query(spark):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in TEXTS],
                               "doc_id long, text string, t string, _g int").repartition(4)
    got = fp.compare_neighbours(df).collect()
    tie = {r["t"]: r["h"] for r in spark.createDataFrame(
        [(t or "",) for _, t in TEXTS], "t string").select("t", F.xxhash64("t").alias("h")).collect()}
    rows = sorted(((i, t or "") for i, t in TEXTS),
                  key=lambda r: (r[0] is not None, r[0] or 0, tie[r[1]]))
    want = []
    for (i, t), (_, o) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        e = t[:len(t) - half] + o[:half]
        a, b, c = plain_print(t), plain_print(e), plain_print(o)
        want.append((i, len(t), sha(e), a, b, plain_likeness(a, b), plain_likeness(a, c)))
    key = lambda r: repr(tuple(r))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_leaves_put_together_are_the_line():
    for n in range(200):
        line = some_text(n).replace("\n", "") + "d " * n
        assert "".join(plain_leaves(line)) == line


def test_hundred_thousand_lines_take_seconds(spark):
    text = "\n".join(f"line {k} of a log. It says {k % 97}." for k in range(100_000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.time()
    got = fp.compare_neighbours(df).first()
    assert time.time() - began < 60
    assert got["fingerprint"] == plain_print(text) and got["near_edited"] > 0.4


def next_of(spark, ids):
    df = spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "id long, n long").repartition(4)
    order = {r["n"]: r["h"] for r in df.select("n", F.xxhash64("n").alias("h")).collect()}
    got = {r["n"]: r["next_n"] for r in with_next(
        df, F.col("id"), F.xxhash64("n"), ["n"]).collect()}
    rows = sorted(range(len(ids)), key=lambda n: (ids[n] is not None, ids[n] or 0, order[n]))
    assert got == dict(zip(rows, rows[1:] + rows[:1]))
    return df


@pytest.mark.parametrize("ids", [
    [7], [None], [None, None, 5], [5] * 40, list(range(3000)) + [1 << 62],
    [None] * 10_000 + list(range(-500, 500)) + [-(2 ** 63), 2 ** 63 - 1],
    [9] * 5000 + list(range(0, 10**9, 10**5)) + [12] * 4000])
def test_order_of_neighbours(spark, ids):
    next_of(spark, ids)


@pytest.mark.parametrize("ids", [list(range(200_000)) + [1 << 62],
                                 [-2 ** 63] * 200_000 + list(range(1000))])
def test_groups_stay_small(spark, ids):
    """An outlying id, and 200,000 rows without one."""
    df = spark.createDataFrame([(i,) for i in ids], "id long").withColumn(
        "h", F.xxhash64(F.monotonically_increasing_id()))
    n, borders = df.agg(F.count("*"), F.percentile_approx(
        "id", [i / QUANTILES for i in range(QUANTILES)])).first()
    cuts = Ranges([min(ids), *borders], max(ids), n)
    sizes = [r["count"] for r in df.groupBy(cuts.group(F.col("id"), F.col("h"))).count().collect()]
    assert sum(sizes) == len(ids) and max(sizes) < 4 * GROUP
