"""Ranked search, line dedup and tokenizer alignment against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from pyspark.sql import functions as F  # noqa: E402

from parcelwise.llm import alignment, line_runs, queries, ranked  # noqa: E402
from parcelwise.sources.scratch import Scratch  # noqa: E402

rng = random.Random(11)
WORDS = ["the", "The", "of", "und", "né", "NÉ", "x1", "漢字", "alpha", "beta", "a_b", "c-d", "0"]
CLASH = "item slice owner lane a b k r s row keys place dropped text_ docs".split()


def prose(n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", str(rng.randrange(30))])
                    for _ in range(n))


SAME = prose(25)
TEXTS = [(i, prose(rng.randrange(1, 60))) for i in range(60)] + [
    (60, None), (61, ""), (62, " \t\x1f-"), (63, SAME), (64, SAME), (65, SAME), (65, SAME),
    (66, prose(20_000)), (None, prose(9)), (None, prose(9)), (67, "\x1c\x85　 ﬁ <|endoftext|> <s>  two")]


def frame(spark, rows, name="doc_id"):
    extra = [str(k) for k in range(len(CLASH))]
    return spark.createDataFrame(
        [(i, t, *extra) for i, t in rows],
        f"{name} long, text string, " + ", ".join(f"{c} string" for c in CLASH)).repartition(3)


@pytest.fixture(scope="module")
def save(spark):
    return Scratch(spark, "test").save


# --- ranked search ---------------------------------------------------------------
ITEMS = [(1, prose(12)), (2, SAME), (2, "alpha alpha ALPHA"), (3, None), (4, ""), (None, "beta"),
         (5, "no such words here"), *[(k, prose(6)) for k in range(6, 12)]]


def plain_terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def plain_search(texts, items, top):
    docs = [(i, plain_terms(t)) for i, t in texts]
    n_docs, n_terms = sum(bool(t) for _, t in docs), sum(len(t) for _, t in docs)
    df = Counter(t for _, ts in docs for t in set(ts))
    asked = defaultdict(list)
    for i, t in items:
        asked[i] += plain_terms(t)
    out = set()
    for item, terms in asked.items():
        found = []
        for i, ts in docs:
            tf, score = Counter(ts), 0
            for t in terms:
                if tf[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 75 + 25 * len(ts) * n_docs // n_terms
                    score += w * (10**9 * tf[t] // (1000 * tf[t] + 12 * m))
            if score > 0:
                found.append((-score, i is None, i))
        out |= {(item, r, f[2], -f[0]) for r, f in enumerate(sorted(
            found, key=lambda f: (f[0], f[1], f[2] or 0))[:top], 1)}
    return out


@pytest.mark.parametrize("bundle,slice_docs", [(64, 8192), (1, 7)])
def test_search(spark, save, monkeypatch, bundle, slice_docs):
    """Few bundles and one slice a task, and several lanes and small slices."""
    monkeypatch.setattr(ranked, "BUNDLE", bundle)
    monkeypatch.setattr(ranked, "SLICE_DOCS", slice_docs)
    found = ranked.search(frame(spark, TEXTS), frame(spark, ITEMS, "item_id"), save, top=9)
    got = [tuple(r) for r in found.collect()]
    want = plain_search(TEXTS, ITEMS, 9)
    assert len(got) == len(want) and set(got) == want
    assert len({g[:2] for g in got}) == len(got) and {None, 2} <= {g[0] for g in got}


def test_search_of_nothing(spark, save):
    none, items = frame(spark, TEXTS).limit(0), frame(spark, ITEMS, "item_id")
    assert ranked.search(none, items, save).collect() == []
    assert ranked.search(frame(spark, TEXTS), items.limit(0), save).collect() == []
    blank = frame(spark, [(1, None), (2, "--")])
    assert ranked.search(blank, items, save).collect() == []


def test_every_document_is_found_at_equal_scores(spark, save):
    rows = [(i, "alpha") for i in range(40, 0, -1)]
    got = ranked.search(frame(spark, rows + [(99, "beta")] * 90),
                        frame(spark, [(7, "alpha")], "item_id"), save).collect()
    assert [(r["rank"], r["doc_id"]) for r in sorted(got, key=lambda r: r["rank"])] == \
        [(k, k) for k in range(1, 21)]


def test_terms_and_hashes_agree_with_spark(spark):
    rows = spark.createDataFrame(TEXTS, "i long, t string").where("t is not null").select(
        "t", ranked.terms(F.col("t")).alias("ts"))
    for r in rows.collect():
        assert [t.decode() for t in ranked.terms_of(r["t"])] == r["ts"] == plain_terms(r["t"])
    wanted = rows.select(F.explode("ts").alias("term")).distinct()
    asked = ranked.asked_hashes(wanted)
    terms = {r[0].encode() for r in wanted.collect()}
    owners = ranked.Owners(asked)
    assert all(owners[t] >= 0 for t in terms) and 0 < asked.sum() <= len(terms)
    assert owners[b"never asked for"] == -1


# --- line dedup --------------------------------------------------------------------
POOL = [f"Line {k}" for k in range(6)] + ["", "   ", "É x", "É X", "é x", "_"]


def some_lines(n):
    return "\n".join(" " * rng.randrange(3) + rng.choice([str.lower, str.upper, str])(
        rng.choice(POOL[:8])) + rng.choice(["", "\t", "\r", str(rng.randrange(50))])
        for _ in range(n))


LINED = [(i, some_lines(rng.randrange(1, 9))) for i in range(80)] + [
    (80, None), (81, ""), (82, "\n"), (83, "\n\nLine 1\n"), (84, "É x\né x\nÉ X"), (85, "É X"),
    (86, some_lines(30_000)), (None, "Line 1\nown"), (None, "Line 1\nown"), (87, "LINE 2"),
    *[(88, "thrice\nonce more")] * 3, (89, "thrice"), *[(90 + k, "É x") for k in range(3)]]


def plain_lines(texts, limit, min_chars):
    def key(line):
        bare = line.strip(" \t\n\x0b\x0c\r")
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in bare)

    split = [(i, (t or "").split("\n")) for i, t in texts]
    held = Counter(k for _, ls in split for k in {key(x) for x in ls})
    for i, ls in split:
        kept = [x for x in ls if len(key(x)) < min_chars or held[key(x)] < limit]
        yield i, "\n".join(kept), len(ls), len(ls) - len(kept)


def by_id(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


@pytest.mark.parametrize("limit,min_chars,batches,hot", [(10, 1, 4, 10_000), (3, 1, 3, 5),
                                                         (2, 6, 1, 10_000), (1, 1, 5, 2)])
def test_frequent_lines(spark, save, monkeypatch, limit, min_chars, batches, hot):
    monkeypatch.setattr(line_runs, "HOT", hot)
    got = line_runs.without_frequent(frame(spark, LINED), save, limit, min_chars, batches)
    assert got.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    assert by_id(tuple(r) for r in got.collect()) == by_id(plain_lines(LINED, limit, min_chars))


def test_lines_of_no_documents(spark, save):
    assert line_runs.without_frequent(frame(spark, LINED).limit(0), save).collect() == []


def test_runs_are_levelled_sorted_and_hold_a_full_key_once(spark, save):
    runs = line_runs.Runs(save, limit=1)
    for n in range(5):
        batch = spark.range(n * 10, n * 10 + 25).selectExpr(
            "id as a", "-id as b", "1L as docs", "2L as lines")
        assert runs.fresh(batch).count() == (25 if n == 0 else 10)
        runs.add(batch)
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    every = [r["a"] for level in runs.levels for run in level for r in run.collect()]
    assert sorted(every) == list(range(65))
    for run in (r for level in runs.levels for r in level):
        parts = run.select(F.spark_partition_id().alias("p"), "a", "b").collect()
        for p in {r["p"] for r in parts}:
            own = [(r["a"], r["b"]) for r in parts if r["p"] == p]
            assert own == sorted(own)
    plan = runs.fresh(batch)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan


def test_lines_run_no_python(spark, save):
    got = line_runs.without_frequent(frame(spark, LINED), save)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- alignment ---------------------------------------------------------------------
def plain_alignment(texts):
    import sentencepiece
    from tokenizers import Tokenizer
    left = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte = alignment.byte_of_char()

    def a_bytes(i):
        return bytes(byte[c] for c in left.id_to_token(i))

    def b_bytes(i):
        p = right.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if right.is_byte(i) else p.replace("▁", " ").encode()

    found, held = [], Counter()
    for i, t in texts:
        whole = (" " + (t or "")).encode()
        a = left.encode(whole.decode(), add_special_tokens=False).ids if t else []
        b = right.encode(t) if t else []
        if b"".join(map(a_bytes, a)) != whole or b"".join(map(b_bytes, b)) != whole:
            a = b = []
        cover = [[], []]
        for side, (ids, of) in enumerate(((a, a_bytes), (b, b_bytes))):
            at = 0
            for token in ids:
                cover[side].append((at, at + len(of(token)), token))
                at = cover[side][-1][1]
        ends = sorted({x[1] for x in cover[0]} & {x[1] for x in cover[1]})
        groups, last = [], 0
        for e in ends:
            groups.append([",".join(str(x[2]) for x in c if last < x[1] <= e) for c in cover])
            last = e
        links = [(x[2], y[2]) for x in cover[0] for y in cover[1]
                 if x[0] < y[1] and y[0] < x[1]]
        held.update(set(links))
        digest = hashlib.sha256(";".join("|".join(g) for g in groups).encode()).hexdigest()
        found.append((i, len(a), len(b), groups, links, digest if a else ""))
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    for i, n_a, n_b, groups, links, digest in found:
        yield (i, n_a, n_b, len(groups), len(links),
               sum(held[x] == best[x[0]] for x in links), sum(held[x] for x in links), digest)


ALIGNED = [(i, t if t is None or len(t) < 2000 else t[:2000]) for i, t in TEXTS] + [
    (70, "a  b   c\n\n\td \r\n"), (71, "é☃😀é"), (72, "\x00\x01"), (73, "x" * 300),
    (74, " lead"), (75, "▁ piece"), (76, "<0x41> <unk></s>"), (77, "\n"), (78, " ")]


@pytest.mark.parametrize("batch,entries", [(2_000_000, 1_000_000), (150, 60)])
def test_alignment(spark, save, monkeypatch, batch, entries):
    monkeypatch.setattr(alignment, "BATCH", batch)
    monkeypatch.setattr(alignment, "SLICE", entries)
    monkeypatch.setattr(alignment, "STEP", 50)
    got = alignment.meetings(frame(spark, ALIGNED), save, queries.two_tokenizers)
    assert got.columns == ["doc_id", *alignment.COUNTS, "n_best", "count_sum", "groups_sha256"]
    want = by_id(plain_alignment(ALIGNED))
    assert by_id(tuple(r) for r in got.collect()) == want
    assert any(not w[1] for w in want if w[0] == 75) and sum(w[1] > 0 for w in want) > 60


def test_batches_end_where_enough_characters_are_reached(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(alignment, "BATCH", 10)
    texts = ["abc", "", "defgh", "ij", "k" * 40, "é" * 9, "l", "m"]
    given = pa.RecordBatch.from_pydict({"i": list(range(8)), "t": texts})
    parts = [b.column(1).to_pylist() for b in alignment.batches(iter([given, given.slice(0, 0)]))]
    assert parts == [texts[:4], texts[4:5], texts[5:7], texts[7:]]


def test_alignment_of_a_long_text(spark, save):
    text = prose(30_000)
    got = alignment.meetings(frame(spark, [(1, text), (2, "the")]), save,
                             queries.two_tokenizers).collect()
    row, = [r for r in got if r["doc_id"] == 1]
    assert row["n_links"] == row["n_a"] + row["n_b"] - row["n_groups"] > 60_000


def test_alignment_without_tokens(spark, save):
    rows = frame(spark, [(1, None), (2, ""), (None, None)])
    got = alignment.meetings(rows, save, queries.two_tokenizers).collect()
    assert [tuple(r)[1:] for r in got] == [(0, 0, 0, 0, 0, 0, "")] * 3
    assert alignment.meetings(rows.limit(0), save, queries.two_tokenizers).collect() == []


def test_ids_are_those_of_the_vocabulary_file():
    from tokenizers import Tokenizer
    left, right = queries.two_tokenizers()
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    model.encode_special_tokens = True
    chars = [chr(c) for c in (*range(0x20, 0x250), *range(0x370, 0x600), *range(0x2000, 0x2070),
                              *range(0x3000, 0x3100), *range(0x1F600, 0x1F640))]
    texts = ["".join(rng.choice(chars) for _ in range(200)) for _ in range(300)]
    assert left.encode(texts) == [model.encode(" " + t, add_special_tokens=False).ids for t in texts]
    assert np.array_equal(left.size.to_numpy(), [len(t.as_py()) for t in left.token])
