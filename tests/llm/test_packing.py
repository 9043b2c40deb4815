"""Containers: capacity, completeness, little waste."""

import itertools
import random
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagewright.llm import packing as K


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 100), max_size=80))
def test_pack(sizes):
    bins = K.pack(sizes, 100)
    assert sorted(i for b in bins for i in b) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in b) <= 100 for b in bins)


def test_search_never_loses_fill():
    rnd = random.Random(2)
    sizes = [rnd.randint(5, 60) for _ in range(500)]
    first = K.best_fit(sizes, 100)
    after = K.local_search([list(b) for b in first], sizes, 100)
    square = lambda bins: sum(sum(sizes[i] for i in b) ** 2 for b in bins)
    assert square(after) >= square(first) and len(after) <= len(first)
    assert sum(sizes) / (100 * len(after)) > 0.98


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(20, 70), min_size=10, max_size=60))
def test_search_ends_where_no_step_helps(sizes):
    """Every move and exchange, one for one and two for one, into a fuller container from a less full one is tried by hand."""
    bins = K.local_search(K.best_fit(sizes, 100), sizes, 100)
    load = [sum(sizes[i] for i in b) for b in bins]
    for t, given_from in enumerate(bins):
        for k, taken_from in enumerate(bins):
            if load[t] > load[k]:
                for n in (0, 1, 2):
                    for out in itertools.combinations(given_from, n):
                        for i in taken_from:
                            gain = sizes[i] - sum(sizes[a] for a in out)
                            assert not 0 < gain <= 100 - load[t]


def test_search_empties_containers():
    rnd = random.Random(1)
    sizes = [rnd.randint(300, 800) for _ in range(2000)]
    first = K.best_fit(sizes, 2048)
    assert len(K.local_search(first, sizes, 2048)) < len(first)


def test_operator(spark):
    rnd = random.Random(4)
    sizes = {d: rnd.choice([0, rnd.randint(1, 900), rnd.randint(1, 900), 2450]) for d in range(700)}
    df = spark.createDataFrame(list(sizes.items()), "doc_id long, n_tokens long")
    prof = spark.createDataFrame([("a", 1000, 1), ("b", 2000, 0)], "profile string, capacity_tokens int, sep_tokens int")
    rows = K.fill_containers(df, prof, shard_items=150).collect()
    for name, cap, sep in (("a", 1000, 1), ("b", 2000, 0)):
        own = [r for r in rows if r.profile == name]
        total, parts, load = Counter(), Counter(), defaultdict(list)
        for r in own:
            total[r.doc_id] += r.n_tokens
            parts[r.doc_id] += 1
            load[r.container].append(r)
        assert {d: total[d] for d in sizes} == sizes and set(parts) == set(sizes)
        assert all(parts[d] == max(1, -(-n // cap)) for d, n in sizes.items())
        for c in load.values():
            fill = sum(r.n_tokens for r in c) + sep * (len(c) - 1)
            assert fill <= cap and all(r.fill == fill for r in c)
        assert sum(sizes.values()) / (cap * len(load)) > 0.97


def test_sizes_and_empty(spark):
    df = spark.createDataFrame([(1, "hello world"), (1, "hello world"), (2, ""), (3, None), (4, "公司 <|endoftext|>")], "doc_id long, text string")
    sizes = K.token_sizes(df.withColumn("n_tokens", F.lit(0)))
    got = {r.doc_id: r.n_tokens for r in sizes.collect()}
    assert set(got) == {1, 4} and 2 <= got[1] <= 4 and got[4] > 4
    prof = spark.createDataFrame([("a", 10, 1)], "profile string, capacity_tokens int, sep_tokens int")
    assert K.fill_containers(sizes.where("false"), prof).count() == 0
