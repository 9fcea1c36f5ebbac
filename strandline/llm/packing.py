"""Problem 7: documents packed into containers of fixed token capacity (sum-of-squares packing).

First pass, without a shuffle: every task counts the tokens of its documents with a public byte-level tokenizer and places them
online. The state of a task is its open bins only: per residual gap the number of open bins, and their numbers. A document goes
where the sum over all gaps of the squared number of open bins becomes smallest (one numpy pass over the gaps); ties take the
tightest fit, and a new bin is opened only where that is strictly better. Full bins are closed. Documents above the capacity are
cut into full pieces plus a remainder that is packed like any other item; no other document is split.

Second pass: every task reports the bins it leaves less than `FULL` filled (number and fill, no documents), and those of `FAN`
tasks are packed into common containers by the same rule, so a task's last bins don't stay half empty. Only bin ids move.

Assignments depend only on a task's own input, so a lost task is redone with the same bins (ids carry the partition number).

Cases: null texts give no row; empty texts are items of 0 tokens; texts of any length are tokenised whole; repeated rows are
separate items; null or non-positive capacities are ignored; without budgets the result is empty; extra columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..session import materialise

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-tokenisation pattern that belongs to the byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
FULL, FAN = 0.95, 64
CACHE = 400_000
_OUT = "budget_id int, bin_id string, doc_id bigint, piece int, tokens int"


class TokenCounter:
    """Numbers of tokens of whole texts. A piece never spans a space that follows a non-space, so the text is cut before
    single spaces and the counts of the chunks are remembered; runs of three spaces and more are encoded as they are."""

    def __init__(self, path: str = TOKENIZER):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.counts: dict[str, int] = {}

    def count(self, text: str) -> int:
        if not text:
            return 0
        if "   " in text:
            return len(self.encoding.encode_ordinary(text))
        counts, total = self.counts, 0
        if len(counts) > CACHE:
            counts.clear()
        get, encode = counts.get, self.encoding.encode_ordinary
        head, *rest = text.split(" ")
        if head:
            total = len(encode(head))
        for w in rest:
            n = get(w)
            if n is None:
                n = counts[w] = len(encode(" " + w))
            total += n
        return total


class Packer:
    """Online sum-of-squares packing of one task for one capacity."""

    def __init__(self, capacity: int, name: str):
        self.capacity, self.name = capacity, name
        self.count = np.zeros(capacity + 1, dtype=np.int64)  # open bins per residual gap; index 0 stays 0
        self.open: dict[int, list[int]] = {}  # gap -> numbers of its bins
        self.widest = 0  # no open bin has a greater gap
        self.bins = 0

    def _new(self, size: int) -> int:
        self.bins += 1
        self._put(self.capacity - size, self.bins)
        return self.bins

    def _put(self, gap: int, number: int) -> None:
        if gap:
            self.count[gap] += 1
            self.open.setdefault(gap, []).append(number)
            self.widest = max(self.widest, gap)

    def place(self, size: int) -> int:
        """The number of the bin that takes an item of at most the capacity."""
        while self.widest and not self.count[self.widest]:
            self.widest -= 1
        if self.widest < max(size, 1):
            return self._new(size)
        if not size:
            return self.open[self.widest][-1]
        # Moving one bin from gap g to g - size changes the sum of squares by 2 (N(g - size) - N(g)) + 2, an exact fit by 1 - 2 N(g).
        before = self.count[size : self.widest + 1]
        change = np.where(before > 0, 2 * (self.count[: self.widest + 1 - size] - before) + 2, np.iinfo(np.int64).max)
        if before[0]:
            change[0] -= 1
        at = int(change.argmin())
        rest = self.capacity - size
        if (2 * self.count[rest] + 1 if rest else 0) < change[at]:
            return self._new(size)
        gap = size + at
        number = self.open[gap].pop()
        self.count[gap] -= 1
        if not self.open[gap]:
            del self.open[gap]
        self._put(gap - size, number)
        return number

    def underfull(self) -> list[tuple[str, int]]:
        """(bin id, tokens) of the bins below `FULL`."""
        return [(f"{self.name}-{n}", self.capacity - gap) for gap, numbers in sorted(self.open.items()) if gap > (1 - FULL) * self.capacity for n in numbers]

    def assign(self, size: int) -> list[tuple[str, int, int]]:
        """(bin id, piece, tokens) of one document."""
        out, piece = [], 0
        while size > self.capacity:
            out.append((f"{self.name}-{self._new(self.capacity)}", piece, self.capacity))
            size, piece = size - self.capacity, piece + 1
        out.append((f"{self.name}-{self.place(size)}", piece, size))
        return out


def _batches(budgets: list[tuple[int, int]], tokenizer: str):
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = TokenCounter(tokenizer)
        part = TaskContext.get().partitionId() if TaskContext.get() else 0
        packers = [(b, Packer(c, f"{b}-{part}")) for b, c in budgets]
        frame = lambda out: pd.DataFrame(out, columns=["task", "budget_id", "bin_id", "doc_id", "piece", "tokens"]).astype({"task": "int32", "budget_id": "int32", "doc_id": "Int64", "piece": "int32", "tokens": "int32"})
        for pdf in it:
            sizes = [counter.count(t) for t in pdf["text"]]
            order = sorted(range(len(sizes)), key=lambda i: -sizes[i])  # within a batch, large items first
            ids = pdf["doc_id"].tolist()
            yield frame([(part, b, bin_, ids[i], piece, n) for b, packer in packers for i in order for bin_, piece, n in packer.assign(sizes[i])])
        yield frame([(part, b, bin_, None, -1, n) for b, packer in packers for bin_, n in packer.underfull()])

    return run


def _merge(budgets: dict[int, int]):
    """applyInPandas over the underfull bins that `FAN` tasks leave for one budget: the common container of each."""

    def run(key: tuple, bins: pd.DataFrame) -> pd.DataFrame:
        budget, group = key
        packer = Packer(budgets[budget], f"{budget}-m{group}")
        rows = sorted(zip(bins["tokens"], bins["bin_id"], strict=True), reverse=True)
        return pd.DataFrame([(budget, bin_id, f"{packer.name}-{packer.place(int(n))}") for n, bin_id in rows], columns=["budget_id", "bin_id", "container"]).astype({"budget_id": "int32"})

    return run


def pack(documents: DataFrame, budgets: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """`(budget_id, bin_id, doc_id, piece, tokens)` for every document and budget."""
    rows = sorted((r[0], r[1]) for r in budgets.where("budget_id is not null and capacity_tokens > 0").select("budget_id", "capacity_tokens").distinct().limit(1001).collect())
    if len(rows) > 1000:
        raise ValueError("more than 1000 budgets; pack them in several calls")
    texts = documents.where("text is not null and doc_id is not null").select("doc_id", "text")
    placed = materialise(texts.mapInPandas(_batches(rows, tokenizer), f"task int, {_OUT}"), "placed")
    left = placed.where("piece < 0").groupBy("budget_id", F.floor(F.col("task") / FAN).cast("int").alias("group"))
    merged = left.applyInPandas(_merge(dict(rows)), "budget_id int, bin_id string, container string")
    out = placed.where("piece >= 0").join(merged, ["budget_id", "bin_id"], "left")
    return out.select("budget_id", F.coalesce("container", "bin_id").alias("bin_id"), "doc_id", "piece", "tokens")


def fill(packed: DataFrame, budgets: DataFrame) -> DataFrame:
    """Per budget: bins, pieces, tokens and the share of the capacity that is used."""
    bins = packed.groupBy("budget_id", "bin_id").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("pieces"))
    per = bins.groupBy("budget_id").agg(F.count("*").alias("n_bins"), F.sum("pieces").alias("n_pieces"), F.sum("tokens").alias("n_tokens"), F.max("tokens").alias("fullest"))
    return budgets.join(per, "budget_id").select("budget_id", "capacity_tokens", "n_bins", "n_pieces", "n_tokens", "fullest", F.round(F.col("n_tokens") / (F.col("n_bins") * F.col("capacity_tokens")), 4).alias("fill"))
