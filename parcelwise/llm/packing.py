"""Sum-of-squares online packing of tokenised documents into fixed windows.

Every task packs the documents of its own input partition as they stream by, so nothing is
shuffled.  A document gives full windows first; what is left (1 to window - 1 tokens) goes
to the fill level that makes the sum of squared counts of partly filled windows smallest,
counted in an array with one entry per level.  Documents may be cut, so the windows that
are still open at the end are emptied into one another, and the last one is cut into
sequences whose lengths are powers of two, which need no padding.

At most `open_windows` windows stay open in a task; beyond that the emptiest half of them
is settled early in the same way.  Sequence ids are the partition number times 2**33 plus a
running number: the same split read again gives the same rows.

Defined cases: a null text is an empty text; an empty text still holds its end token;
repeated ids and repeated rows are documents of their own; null ids stay null; an empty
table gives no rows.  Columns besides the id and the text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
NEVER = np.int64(1) << 60


class Window:
    __slots__ = ("pieces", "fill")

    def __init__(self):
        self.pieces, self.fill = [], 0

    def put(self, piece: tuple) -> None:
        """piece: (doc, start, ids, total tokens of the document)"""
        self.pieces.append(piece)
        self.fill += len(piece[2])


def levels_that_settle(fill: int) -> list[int]:
    """The powers of two that add up to fill, largest first."""
    return [1 << b for b in range(fill.bit_length() - 1, -1, -1) if fill >> b & 1]


class Packer:
    def __init__(self, window: int, open_windows: int, first_id: int):
        self.window, self.limit, self.next_id = window, open_windows, first_id
        self.count = np.zeros(window + 1, np.int64)  # open windows by fill; 0 and full stay 0
        self.open: dict[int, list[Window]] = {}
        self.n_open = 0
        self.rows: list[tuple] = []

    def emit(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes()), total,
                              self.next_id, offset))
            offset += len(ids)
        self.next_id += 1

    def best_level(self, size: int) -> int:
        """The level h (0: a new window) whose change h -> h + size adds least to the sum of
        squared counts; the fullest such level on ties."""
        n, last = self.count, self.window - size
        gain = 2 * (n[size:] - n[:last + 1])  # joining: n[h + size] + 1 and n[h] - 1
        gain += 2
        gain[0] = 2 * n[size] + 1  # a new window leaves no level
        gain[last] = 1 - 2 * n[last]  # a full window enters none
        gain[1:][n[1:last + 1] == 0] = NEVER
        return last - int(gain[::-1].argmin())

    def add(self, doc, ids: np.ndarray) -> None:
        total, at = len(ids), 0
        while total - at >= self.window:
            self.emit([(doc, at, ids[at:at + self.window], total)])
            at += self.window
        if at == total:
            return
        level = self.best_level(total - at)
        if level:
            window = self.open[level].pop()
            self.count[level] -= 1
            self.n_open -= 1
        else:
            window = Window()
        window.put((doc, at, ids[at:], total))
        if window.fill == self.window:
            self.emit(window.pieces)
            return
        self.open.setdefault(window.fill, []).append(window)
        self.count[window.fill] += 1
        self.n_open += 1
        if self.n_open > self.limit:
            self.settle(self.limit // 2)

    def settle(self, keep: int = 0) -> None:
        """Close all but the `keep` fullest windows by cutting their pieces to fit."""
        windows = sorted((w for ws in self.open.values() for w in ws), key=lambda w: -w.fill)
        stay, go = windows[:keep], windows[keep:]
        self.open, self.count[:], self.n_open = {}, 0, len(stay)
        for w in stay:
            self.open.setdefault(w.fill, []).append(w)
            self.count[w.fill] += 1
        current = Window()
        for doc, start, ids, total in (p for w in go for p in w.pieces):
            while len(ids):
                part = ids[:self.window - current.fill]
                current.put((doc, start, part, total))
                start, ids = start + len(part), ids[len(part):]
                if current.fill == self.window:
                    self.emit(current.pieces)
                    current = Window()
        rest = iter(current.pieces)
        doc, start, ids, total = next(rest, (None, 0, np.zeros(0, np.uint32), 0))
        for size in levels_that_settle(current.fill):
            pieces = []
            while size:
                if not len(ids):
                    doc, start, ids, total = next(rest)
                part = ids[:size]
                pieces.append((doc, start, part, total))
                start, ids, size = start + len(part), ids[len(part):], size - len(part)
            self.emit(pieces)


def pack(docs: DataFrame, tokenizer: Callable[[], Callable[[list[str]], list[np.ndarray]]],
         window: int = 2048, open_windows: int = 4096, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece.  `tokenizer` is called once a task and returns a function from
    texts to uint32 arrays, each with its end token."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = tokenizer()
        packer = Packer(window, open_windows, TaskContext.get().partitionId() << 33)
        for batch in batches:
            texts = [t or "" for t in batch["t"]]
            size, at = 0, 0
            for i, text in enumerate([*texts, None]):  # a few MB at once, however long the rows
                if text is not None:
                    size += len(text)
                if text is None or size > 1 << 22:
                    end = i if text is None else i + 1
                    for k, ids in zip(range(at, end), encode(texts[at:end])):
                        doc = batch["i"].iat[k]
                        packer.add(None if pd.isna(doc) else int(doc), ids)
                    size, at = 0, end
            if packer.rows:
                yield frame(packer)
        packer.settle()
        if packer.rows:
            yield frame(packer)

    def frame(packer: Packer) -> pd.DataFrame:
        out = pd.DataFrame(packer.rows, columns=COLUMNS)
        out["doc_id"] = pd.array([r[0] for r in packer.rows], dtype="Int64")
        packer.rows = []
        return out

    return docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")) \
        .mapInPandas(run, SCHEMA)


def byte_bpe(ranks_path: str, pattern: str, specials: dict[str, int], end_id: int = 1):
    """A tokenizer for `pack` from a rank file; special tokens in a text become their ids.

    The `tokenizers` library reads the same vocabulary and gives the same ids (a test holds
    the two together), at a quarter of this speed.
    """

    def make():
        import base64

        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        model = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=ranks,
                                  special_tokens=specials)

        def encode(texts: list[str]) -> list[np.ndarray]:
            found = []
            for text in texts:
                ids = np.asarray(model.encode_to_numpy(text, allowed_special="all"), "<u4")
                found.append(np.append(ids, np.uint32(end_id)))
            return found

        return encode

    return make
