"""Byte-level BPE with a hierarchical-bitmap rank queue, and decoding.

All distinct pre-tokens of a batch that are not known yet lie in one linked list of
positions, with no link from one pre-token to the next.  The queue has a bucket of
positions per merge rank and three levels of bitmaps above the buckets, so finding the
lowest waiting rank is three find-first-set steps, whatever the number of positions.
Merges in different pre-tokens do not touch, so a bucket is merged as a whole; an entry
whose pair has changed meanwhile is stale and skipped.  The work is linear in the bytes
(times the merges they take part in), also for a pre-token of megabytes.

Inside one pre-token the order matters only if a merge creates a pair of lower rank than
its own.  Such pre-tokens are found while merging and done again one merge at a time.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

NONE = np.int64(1) << 40
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def white_space(pattern: str) -> str:
    r"""The pattern with \s and \S spelled out as Unicode's White_Space, which leaves out
    the separators 0x1C-0x1F."""
    space = r"\t-\r\x20\x85\xa0  -     　"
    return (pattern.replace(r"[^\s", f"[^{space}").replace(r"\s", f"[{space}]")
            .replace(r"\S", f"[^{space}]"))


class Bitmap:
    """The set of ranks that wait, as three levels of 64-bit words."""

    def __init__(self, size: int):
        words = (size >> 6) + 1
        self.low, self.middle, self.top = [0] * words, [0] * ((words >> 6) + 1), 0

    def add(self, rank: int) -> None:
        word = rank >> 6
        self.low[word] |= 1 << (rank & 63)
        self.middle[word >> 6] |= 1 << (word & 63)
        self.top |= 1 << (word >> 6)

    def first(self) -> int:
        a = (self.top & -self.top).bit_length() - 1
        m = self.middle[a]
        b = a << 6 | ((m & -m).bit_length() - 1)
        w = self.low[b]
        return b << 6 | ((w & -w).bit_length() - 1)

    def drop(self, rank: int) -> None:
        word = rank >> 6
        self.low[word] &= ~(1 << (rank & 63))
        if not self.low[word]:
            self.middle[word >> 6] &= ~(1 << (word & 63))
            if not self.middle[word >> 6]:
                self.top &= ~(1 << (word >> 6))


class Encoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        self.token = {v: k for k, v in ranks.items()}
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for whole, rank in ranks.items():
            for cut in range(1, len(whole)):
                left, right = ranks.get(whole[:cut]), ranks.get(whole[cut:])
                if left is not None and right is not None:
                    pairs[left * self.size + right] = rank
        keys = np.fromiter(pairs, np.int64, len(pairs))
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.values = np.append(np.fromiter(pairs.values(), np.int64, len(pairs))[order], NONE)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.values[at], NONE)

    def encode(self, pieces: list[bytes]) -> list[list[int]]:
        """Token ids of each pre-token."""
        out: list = [[self.ranks[p]] if p in self.ranks else [] if not p else None
                     for p in pieces]
        todo = [i for i, ids in enumerate(out) if ids is None]
        if todo:
            for i, ids in zip(todo, self._merge([pieces[i] for i in todo])):
                out[i] = ids
        return out

    def _merge(self, pieces: list[bytes]) -> list[list[int]]:
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        ends = np.cumsum(sizes)
        n = int(ends[-1])
        token = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1] = -1
        before[ends - sizes] = -1
        rank = np.full(n, NONE)  # of the pair that starts here; -1: merged away
        inner = np.flatnonzero(after >= 0)
        rank[inner] = self.pair_ranks(token[inner], token[inner + 1])
        buckets: dict[int, list[np.ndarray]] = {}
        waiting = Bitmap(self.size)
        again: set[int] = set()

        def push(at: np.ndarray) -> None:
            at = at[rank[at] < NONE]
            if not len(at):
                return
            at = at[np.argsort(rank[at], kind="stable")]
            r = rank[at]
            cuts = np.flatnonzero(np.diff(r)) + 1
            starts = [0, *cuts.tolist()]
            for key, a, b in zip(r[starts].tolist(), starts, [*starts[1:], len(at)]):
                if key in buckets:
                    buckets[key].append(at[a:b])
                else:
                    buckets[key] = [at[a:b]]
                    waiting.add(key)

        push(inner)
        while waiting.top:
            r = waiting.first()
            waiting.drop(r)
            found = buckets.pop(r)
            at = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
            at = at[rank[at] == r]
            if not len(at):
                continue
            if len(at) > 1:  # of pairs that share a token, the left one goes first
                fresh = np.r_[True, after[at[:-1]] != at[1:]]
                index = np.arange(len(at))
                at = at[(index - np.maximum.accumulate(np.where(fresh, index, 0))) % 2 == 0]
            gone = after[at]
            beyond = after[gone]
            token[at] = r
            after[at] = beyond
            rank[gone] = -1
            inside = beyond >= 0
            before[beyond[inside]] = at[inside]
            rank[at] = NONE
            left = before[at]
            left = left[left >= 0]
            fresh = np.concatenate([at[inside], left])
            fresh = np.unique(fresh) if len(fresh) > 1 else fresh
            rank[fresh] = self.pair_ranks(token[fresh], token[after[fresh]])
            lower = fresh[rank[fresh] < r]
            if len(lower):
                again.update(np.searchsorted(ends, lower, side="right").tolist())
            push(fresh)
        alive = np.flatnonzero(rank >= 0)
        ids, cut = token[alive].tolist(), np.searchsorted(alive, ends).tolist()
        out = [ids[a:b] for a, b in zip([0, *cut[:-1]], cut)]
        for i in again:
            out[i] = self._one(pieces[i])
        return out

    def _one(self, piece: bytes) -> list[int]:
        """One merge at a time: lowest rank, then leftmost."""
        n, ranks = len(piece), self.ranks
        end = list(range(1, n + 1))  # of the token that starts here
        before = list(range(-1, n - 1))
        rank = [-1] * n
        waiting, buckets = Bitmap(self.size), {}

        def look(at: int) -> None:
            rank[at] = -1
            if end[at] < n:
                r = ranks.get(piece[at:end[end[at]]])
                if r is not None:
                    rank[at] = r
                    heappush(buckets.setdefault(r, []), at)
                    waiting.add(r)

        for i in range(n):
            look(i)
        while waiting.top:
            r = waiting.first()
            at = heappop(buckets[r])
            if not buckets[r]:
                waiting.drop(r)
            if rank[at] != r:
                continue
            gone = end[at]
            end[at], rank[gone] = end[gone], -1
            if end[at] < n:
                before[end[at]] = at
            look(at)
            if before[at] >= 0:
                look(before[at])
        ids, i = [], 0
        while i < n:
            ids.append(ranks[piece[i:end[i]]])
            i = end[i]
        return ids

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class Memory:
    """Ids (as text) and decoded bytes of the pre-tokens met lately, for one worker."""

    def __init__(self, encoder: Encoder, limit: int):
        self.encoder, self.limit = encoder, limit
        self.ids: dict[str, str] = {}
        self.bytes: dict[str, bytes] = {}

    def learn(self, pieces: set[str]) -> None:
        new = [p for p in pieces if p not in self.ids]
        if len(self.ids) + len(new) > self.limit:
            self.ids, self.bytes, new = {}, {}, list(pieces)
        found = self.encoder.encode([p.encode("utf-8", "surrogatepass") for p in new])
        for piece, ids in zip(new, found):
            self.ids[piece] = ",".join(map(str, ids))
            self.bytes[piece] = self.encoder.decode(ids)


_memories: dict[tuple, Memory] = {}


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
               text_col: str = "text", remember: int = 300_000) -> DataFrame:
    """Encode every text and decode the ids again; one row of digests per document.

    ids_sha256 is over the decimal ids joined by commas, decoded_sha256 over the bytes that
    decoding returned.  A worker keeps what it knows of at most `remember` pre-tokens (or of
    one part of a batch) between batches.  Defined cases: null and empty texts have no token
    and the digests of an empty string; repeated rows give repeated rows; null ids stay
    null; other columns are ignored.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import regex

        key = (ranks_path, remember)
        if key not in _memories:
            _memories[key] = Memory(Encoder(read_ranks(ranks_path)), remember)
        memory, split = _memories[key], regex.compile(white_space(pattern)).findall
        for batch in batches:
            rows, texts, size, part = [], batch["t"], 0, []
            for i in range(len(batch)):
                pieces = split(texts.iat[i] or "")
                part.append(pieces)
                size += len(pieces)
                if size > 1 << 20 or i + 1 == len(batch):
                    memory.learn(set().union(*part))
                    ids, raw = memory.ids.__getitem__, memory.bytes.__getitem__
                    for pieces in part:
                        joined = ",".join(map(ids, pieces))
                        rows.append((joined.count(",") + 1 if joined else 0,
                                     hashlib.sha256(joined.encode()).hexdigest(),
                                     hashlib.sha256(b"".join(map(raw, pieces))).hexdigest()))
                    size, part = 0, []
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, "doc_id", batch["i"].astype("Int64").array)
            yield out

    return docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")) \
        .mapInPandas(run, SCHEMA)


def token_ids(texts: list[str], encoder: Encoder, pattern: str) -> list[list[int]]:
    """Ids of whole texts, for callers that want them rather than digests."""
    import regex

    split = regex.compile(white_space(pattern)).findall
    parts = [split(t or "") for t in texts]
    known = list({p for ps in parts for p in ps})
    ids = dict(zip(known, encoder.encode([p.encode("utf-8", "surrogatepass") for p in known])))
    return [[i for p in ps for i in ids[p]] for ps in parts]
