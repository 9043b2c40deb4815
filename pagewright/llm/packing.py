"""Filling fixed-capacity containers with items.

Texts are sized in tokens of a public tokenizer. They are packed in shards of a bounded number of texts (a hash of the id decides, so no shard
is hot): a first packing best-fit in falling size, then swap-based local search - move a text, exchange one for one or two for one between
underfull containers - that increases the sum of squared fills until containers empty. The underfull containers left by all shards are
pooled and packed again, so the number of shards costs next to nothing.
"""

from __future__ import annotations

import base64
import math
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .textform import per_distinct

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: how that tokenizer cuts a text before it merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PACKED = "profile string, doc_id long, part_no int, n_tokens long, container string, fill long"


@lru_cache(maxsize=2)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_sizes(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", tokenizer: str = TOKENIZER, pattern: str = PATTERN) -> DataFrame:
    """``doc_id, n_tokens`` of each non-empty text; ``tokenizer`` is the path of a ``.tiktoken`` file on every node, ``pattern`` its way to cut texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(tokenizer, pattern).encode_ordinary
        for b in batches:
            n = per_distinct(b.column("text"), lambda t: len(encode(t)), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), n], ["doc_id", "n_tokens"])

    texts = df.where((F.length(text_col) > 0) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # A document given twice counts once.
    return texts.mapInArrow(count, "doc_id long not null, n_tokens long not null").groupBy("doc_id").agg(F.max("n_tokens").alias("n_tokens"))


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Containers (lists of item numbers), best fit in falling size. Ties keep the order of the items."""
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []  # free space and container, sorted
    for i in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        s = sizes[i]
        at = bisect_left(room, (s, -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            free, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        insort(room, (free - s, b))
    return bins


class _Search:
    """Containers under search. ``pool`` has the items of all open containers in order of size; those fuller than the one being filled are closed."""

    def __init__(self, bins: list[list[int]], sizes: list[int], capacity: int):
        self.bins, self.sizes, self.capacity = bins, sizes, capacity
        self.load = [sum(sizes[i] for i in b) for b in bins]
        self.home = {i: k for k, b in enumerate(bins) for i in b}
        self.pool: list[tuple[int, int]] = []

    def run(self) -> None:
        changed = True
        while changed:
            changed = False
            order = sorted((k for k, b in enumerate(self.bins) if b and self.load[k] < self.capacity), key=lambda k: (-self.load[k], k))
            self.pool = sorted((self.sizes[i], i) for k in order for i in self.bins[k])
            for t in order:
                for i in self.bins[t]:
                    self.pool.pop(bisect_left(self.pool, (self.sizes[i], i)))
                # All open containers are emptier than this one, or are made emptier by its own steps.
                while self.load[t] < self.capacity and self.bins[t] and self.step(t):
                    changed = True

    def largest(self, limit: int, above: int, most: int) -> int | None:
        """The largest open item of at most ``limit`` and more than ``above`` that stands in a container with a load of at most ``most``."""
        at = bisect_right(self.pool, (limit, len(self.sizes))) - 1
        while at >= 0 and self.pool[at][0] > above:
            if self.load[self.home[self.pool[at][1]]] <= most:
                return self.pool[at][1]
            at -= 1
        return None

    def step(self, t: int) -> bool:
        """The best of all moves, exchanges one for one and two for one into a container: the one that fills most of its space."""
        sizes, free, most = self.sizes, self.capacity - self.load[t], self.load[t]
        best, out, hit = 0, (), self.largest(free, 0, most)
        if hit is not None:
            best = sizes[hit]
        for n in (1, 2):
            if best == free:
                break
            tried = set()
            for given in combinations(self.bins[t], n):
                s = sum(sizes[a] for a in given)
                if s in tried:
                    continue
                tried.add(s)
                other = self.largest(s + free, s + best, most)
                if other is not None:
                    best, out, hit = sizes[other] - s, given, other
                    if best == free:
                        break
        if not best:
            return False
        k, back = self.home[hit], sum(sizes[a] for a in out)
        self.pool.pop(bisect_left(self.pool, (sizes[hit], hit)))
        self.bins[k].remove(hit)
        self.bins[t].append(hit)
        self.home[hit] = t
        for a in out:
            self.bins[t].remove(a)
            self.bins[k].append(a)
            self.home[a] = k
            insort(self.pool, (sizes[a], a))
        self.load[t] += sizes[hit] - back
        self.load[k] += back - sizes[hit]
        return True


def local_search(bins: list[list[int]], sizes: list[int], capacity: int) -> list[list[int]]:
    """Containers after moves and swaps between underfull ones, until none is left that helps. Every step takes from a container that is at most as
    full, so the sum of squared fills rises and the search ends; containers that run empty are dropped."""
    search = _Search([list(b) for b in bins], sizes, capacity)
    search.run()
    return [b for b in search.bins if b]


def pack(sizes: list[int], capacity: int) -> list[list[int]]:
    """Containers of at most ``capacity`` for sizes that each fit in one."""
    return local_search(best_fit(sizes, capacity), sizes, capacity)


def fill_containers(
    sizes: DataFrame, profiles: DataFrame, shard_items: int = 2000, full_enough: float = 0.98, max_profiles: int = 100
) -> DataFrame:
    """``profile, doc_id, part_no, n_tokens, container, fill``: the container of each text under each profile.

    ``sizes`` has ``doc_id, n_tokens``; ``profiles`` are settings (``profile, capacity_tokens, sep_tokens``), of which at most
    ``max_profiles`` are accepted. A text above the capacity is split into parts of the capacity and a rest; no other text is split. ``fill``
    counts the tokens of a container with separators. Empty tables give an empty result; texts without tokens share any container.
    """
    settings = [r for r in profiles.select("profile", "capacity_tokens", "sep_tokens").limit(max_profiles + 1).collect() if None not in tuple(r)]
    if len(settings) > max_profiles:
        raise ValueError(f"more than {max_profiles} profiles")
    sizes = cut(sizes.where(F.col("n_tokens").isNotNull()).select("doc_id", "n_tokens"))  # tokenised once for the count and all profiles
    n = sizes.count()
    setting = F.explode(F.array(*[F.struct(F.lit(p).alias("profile"), F.lit(int(c)).cast("long").alias("cap"), F.lit(int(s)).cast("long").alias("sep")) for p, c, s in settings]))
    items = sizes.select("doc_id", "n_tokens", setting.alias("_s")).select("doc_id", "n_tokens", "_s.*")
    parts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col("n_tokens") / F.col("cap")).cast("int") - 1))
    items = items.select("profile", "cap", "sep", "doc_id", "n_tokens", F.explode(parts).alias("part_no"))
    items = items.withColumn("n_tokens", F.least(F.col("cap"), F.col("n_tokens") - F.col("part_no") * F.col("cap")))

    def packed(stage: str):
        def of(pdf: pd.DataFrame) -> pd.DataFrame:
            cap, sep = int(pdf["cap"].iloc[0]), int(pdf["sep"].iloc[0])
            pdf = pdf.sort_values(["doc_id", "part_no"], ignore_index=True)
            # With the separator counted to each text and once to the capacity, loads simply add up.
            bins = pack([int(s) + sep for s in pdf["n_tokens"]], cap + sep)
            name, fill = [""] * len(pdf), [0] * len(pdf)
            shard = int(pdf["shard"].iloc[0])
            for k, b in enumerate(bins):
                load = sum(int(pdf["n_tokens"].iloc[i]) for i in b) + sep * (len(b) - 1)
                for i in b:
                    name[i], fill[i] = f"{stage}{shard}-{k}", load
            return pdf.assign(container=name, fill=fill)[["profile", "cap", "sep", "doc_id", "part_no", "n_tokens", "container", "fill"]]

        return of

    shape = "profile string, cap long, sep long, doc_id long, part_no int, n_tokens long, container string, fill long"

    def sharded(rows: DataFrame, count: int) -> DataFrame:
        shards = max(1, math.ceil(count / shard_items))
        return rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "part_no"), F.lit(shards)))

    first = cut(sharded(items, n).groupBy("profile", "shard").applyInPandas(packed("a"), shape))
    done = F.col("fill") >= F.col("cap") * full_enough
    left = first.where(~done).select("profile", "cap", "sep", "doc_id", "part_no", "n_tokens")
    counts = left.groupBy("profile").count().agg(F.max("count")).first()[0] or 0
    second = sharded(left, counts).groupBy("profile", "shard").applyInPandas(packed("b"), shape)
    return first.where(done).unionByName(second).select("profile", "doc_id", "part_no", "n_tokens", "container", "fill")


def container_fill(assigned: DataFrame, profiles: DataFrame) -> DataFrame:
    """``profile, n_containers, n_tokens, unused_tokens, fill_share`` of an assignment."""
    each = assigned.groupBy("profile", "container").agg(F.max("fill").alias("fill"), F.sum("n_tokens").alias("n"))
    total = each.groupBy("profile").agg(F.count(F.lit(1)).alias("n_containers"), F.sum("n").alias("n_tokens"), F.sum("fill").alias("_f"))
    caps = profiles.groupBy("profile").agg(F.max("capacity_tokens").alias("_c"))
    out = total.join(caps, "profile")
    room = F.col("n_containers") * F.col("_c")
    return out.select("profile", "n_containers", "n_tokens", (room - F.col("_f")).alias("unused_tokens"), (F.col("_f") / room).alias("fill_share"))
